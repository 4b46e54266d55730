"""Packing: exact round trip, gapless sequences, little padding, best borders."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadsift.llm import packing


def tokens(text):
    tokenizer = Tokenizer.from_file(packing.public_file())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check(rows, pairs, length):
    """Every id of every document in exactly one piece, and every sequence gapless."""
    by_text = {}
    for doc_id, text in pairs:
        by_text.setdefault(doc_id, []).append(tokens(text))
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
    for doc_id, wanted in by_text.items():
        for ids in wanted:
            pieces = sorted(got[(doc_id, len(ids))], key=lambda r: r.start)
            same = sum(len(x) == len(ids) for x in wanted)
            assert sum(r.length for r in pieces) == len(ids) * same
            if same == 1:
                assert b"".join(bytes(r.ids) for r in pieces) == np.array(ids, dtype="<u4").tobytes()
                assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return sequences


@pytest.mark.parametrize("length", [64, 4096])
def test_round_trip(documents, monkeypatch, length):
    monkeypatch.setattr(packing, "WINDOW", 3000)
    rng = random.Random(length)
    words = ["alpha", "Beta.", "gamma,", "delté!", "x?", "12", "don't", "<|endoftext|>", "<|startoftext|>", "İ", "Å", "é.", "A.", "_.", " q"]
    pairs = [(i, rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.randint(0, 300)))) for i in range(60)]
    pairs += [(100, None), (101, ""), (102, "word " * 9000), (103, "a" * 3000), (None, "last one"), (104, "twice"), (104, "twice")]
    frame = documents(pairs, {"start": F.lit("s"), "ids": F.lit(0), "k": F.lit(1)})
    rows = packing.pieces(frame, length=length, keep_ids=True).collect()
    sequences = check(rows, pairs, length)
    total = sum(len(tokens(t)) for _, t in pairs)
    padded = sum(n if n & (n - 1) == 0 else length for n in (sum(r.length for r in s) for s in sequences.values()))
    assert total / padded > 0.9


def test_encoder_gives_the_ids_of_the_library():
    tokenizer = Tokenizer.from_file(packing.public_file())
    encoder = packing.Encoder(packing.public_file())
    texts = [
        "a b c\x1cd e\x85f", "<|startoftext|>x <|endoftext|> <|STARTOFTEXT|>", "é é ́x", "don't I'LL 123 ½ ３.", "İSTANBUL Σας ΟΔΟΣ.",
        "", " ", "\n\n", "​x﻿", "a" * 5000, "\r\n\x0b\x0cq", "ﬁ Å Å 각", "Dr., \"Who\"., x.., a_. _, 5. 6, 7.8, end.", "Ünï. Ö, ß.", "ǅ ŉ. ẞ",
    ]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, (ids, ends), w in zip(texts, encoder.encode(texts), want):
        assert ids.tolist() == w.ids, text
        assert all(0 <= e <= len(ids) for e in ends.tolist())
    encoder.MOST = 3
    for text, (ids, _), w in zip(texts, encoder.encode(texts), want):
        assert ids.tolist() == w.ids, text


def test_encoder_on_letters_that_normalisation_takes_apart():
    """Every letter below U+20000 before a stop and a comma, where the library's ids differ from those of the parts."""
    tokenizer = Tokenizer.from_file(packing.public_file())
    encoder = packing.Encoder(packing.public_file())
    known = [0x130, *range(0x958, 0x960), *range(0x9DC, 0x9E0), 0xA33, 0xA36, 0xA59, 0xA5A, 0xA5B, 0xA5E, 0xB5C, 0xB5D, 0xF43, 0xFB2A, 0xFB4E]
    others = [c for c in range(0x20, 0x20000) if chr(c).isalnum() and not 0xD800 <= c < 0xE000]
    letters = [*map(chr, known), *map(chr, others)]
    texts = [f"{a}. x{a}, {a}" for a in letters]
    for begin in range(0, len(texts), 5000):
        part = texts[begin : begin + 5000]
        want = tokenizer.encode_batch_fast(part, add_special_tokens=False)
        for text, (ids, _), w in zip(part, encoder.encode(part), want):
            assert ids.tolist() == w.ids, text


def test_encoder_on_random_strings():
    rng = random.Random(17)
    pieces = ["İ", "i̇", "̇", "́", "़", "ड़", "ø", "é", "Σ", "ς", "ß", "ŉ", "a", "B", "1", "½", ".", ",", ". ", ", ", " ", "\n", "'s", "<|startoftext|>", "<|", "|>", "日", "😀", "\u200d", "\u0f43", "\ufb2a", "!", "_"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(20_000)]
    tokenizer = Tokenizer.from_file(packing.public_file())
    encoder = packing.Encoder(packing.public_file())
    want = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for text, (ids, _), w in zip(texts, encoder.encode(texts), want):
        assert ids.tolist() == w.ids, repr(text)


def test_borders_are_best():
    """The monotone queue against plain dynamic programming."""
    rng = random.Random(1)
    for _ in range(30):
        n, length = rng.randint(1, 200), 16
        at = sorted(set(rng.sample(range(1, n + 1), rng.randint(1, min(n, 60)))) | {n})
        borders = np.array(at, dtype=np.int64)
        costs = np.array([rng.choice([0.0, 4.0]) for _ in at])
        borders, costs = packing.with_inner_borders(borders, costs, n, length)
        if borders[-1] != n:
            continue
        found = packing.choose(packing.Stream(n, borders, costs), length)
        cost_at = dict(zip(borders.tolist(), costs.tolist()))

        def price(a, b):
            size = b - a
            free = n - b <= length and size & (size - 1) == 0
            return (0 if free else length - size) + cost_at[b] + packing.SEQUENCE_COST

        best = {0: 0.0}
        for b in borders.tolist():
            best[b] = min(best[a] + price(a, b) for a in best if 0 < b - a <= length)
        total = sum(price(a, b) for a, b in zip([0, *found], found))
        assert total == pytest.approx(best[n])


def test_empty_table(documents):
    assert packing.pieces(documents([])).collect() == []
