"""Alignment of two tokenizers against a byte-by-byte version."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders

from threadsift.llm import alignment

A_PATH, B_PATH = alignment.public_file("byte_bpe_50k.json"), alignment.public_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def byte_names():
    """Learnt from the library's own decoder: which letter stands for which byte."""
    vocabulary = Tokenizer.from_file(A_PATH).get_vocab()
    letters = {c for t in vocabulary for c in t}
    byte = {}
    for c in letters:
        text = decoders.ByteLevel().decode([c])
        if text != "�":
            byte[c] = text.encode()[0]
    rest = sorted(letters - byte.keys())
    high = [b for b in range(256) if b not in byte.values()]
    # Continuation and lead bytes cannot be decoded alone; the letters follow the bytes in two runs.
    byte.update(zip([c for c in rest if ord(c) < 0x100], [ord(c) for c in rest if ord(c) < 0x100]))
    left = [b for b in high if b not in byte.values()]
    byte.update(zip([c for c in rest if ord(c) >= 0x100], left))
    return byte


def brute(tools, texts):
    a, b = tools
    byte = byte_names()
    docs, pairs = [], Counter()
    for text in texts:
        ids_a, ids_b, cut_a, cut_b = [], [], [], []
        if text:
            whole = (" " + text).encode()
            e = a.encode(" " + text, add_special_tokens=False)
            parts_a = [bytes(byte[c] for c in t) for t in e.tokens]
            ids = b.encode(text)
            pieces = [b.id_to_piece(i) for i in ids]
            parts_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]
            if b"".join(parts_a) == whole == b"".join(parts_b):
                ids_a, ids_b = e.ids, ids
                cut_a = [sum(map(len, parts_a[: i + 1])) for i in range(len(parts_a))]
                cut_b = [sum(map(len, parts_b[: i + 1])) for i in range(len(parts_b))]
        links = []
        begin_a = [0, *cut_a]
        begin_b = [0, *cut_b]
        for i in range(len(ids_a)):
            for j in range(len(ids_b)):
                if max(begin_a[i], begin_b[j]) < min(cut_a[i], cut_b[j]):
                    links.append((ids_a[i], ids_b[j]))
        pairs.update(links)
        common = sorted(set(cut_a) & set(cut_b))
        groups, before = [], 0
        for c in common:
            left = [str(t) for t, e in zip(ids_a, cut_a) if before < e <= c]
            right = [str(t) for t, e in zip(ids_b, cut_b) if before < e <= c]
            groups.append(",".join(left) + "|" + ",".join(right))
            before = c
        docs.append((len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    highest = Counter()
    for (_, j), n in pairs.items():
        highest[j] = max(highest[j], n)
    return [
        (na, nb, ng, len(links), sum(pairs[p] == highest[p[1]] for p in links), sum(pairs[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for na, nb, ng, links, g in docs
    ]


def corpus():
    rng = random.Random(5)
    parts = ["the ", "word", "  ", "\n", "\t", "é", "𐍈", "日本語", "x̂", "नमस्ते", "<s>", "</s>", "<|endoftext|>", "<unk>", "<0x41>", "😀👩‍👩‍👧", "1234567", "don't", " ", "ﬁ", "\x00", "​", "a" * 40, "🏳️‍🌈"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(120)]
    texts += [None, "", " ", "  two", "end ", "▁", "with ▁ inside", "a", "\n", "﻿x", "é", "\r\n", "é" * 200, "😀" * 50, "the same text again", "the same text again"]
    return texts


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("hot", [0, 300, 1 << 18])
def test_equals_brute_force(documents, tools, monkeypatch, hot):
    """With hot = 0 every pair is joined, with 2^18 all are shipped, with 300 some."""
    monkeypatch.setattr(alignment, "HOT", hot)
    texts = corpus()
    frame = documents(list(enumerate(texts)), {"k": F.lit(1), "n_a": F.lit("x"), "links": F.lit(0), "pair": F.lit(1)}).repartition(3)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in alignment.digests(frame).collect()}
    assert got == dict(enumerate(brute(tools, texts)))
    assert got[120] == (0, 0, 0, 0, 0, 0, "") and got[126][0] > 0 or got[125][0] == 0


def test_parts_are_read_alike_alone_and_together(tools):
    """Texts cut at spaces give the tokens of whole texts; also when memory is short."""
    rng = random.Random(8)
    letters = ["a", "B", ",", "!", "?\n", "x\n", "é", "日", "1", ".", "'s", "-", " ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "\u200b", "😀", "\u0301", "the", "▁"]
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(4000)]
    memory = alignment.Memory(A_PATH, B_PATH)
    assert all(place in memory.cut.pattern for place in alignment._PLACES)
    memory.MOST = 500
    a, b = tools
    found = [f for i in range(0, len(texts), 100) for f in memory.align(texts[i : i + 100])]
    for text, (n_a, n_b, _, groups, _) in zip(texts, found):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if "▁" in text:
            assert n_a == n_b == 0
            continue
        sides = [g.split("|") for g in groups.split(";")]
        assert [int(i) for left, _ in sides for i in left.split(",")] == ids_a, repr(text)
        assert [int(i) for _, right in sides for i in right.split(",")] == ids_b, repr(text)


def test_texts_that_normalisation_changes_have_no_tokens(documents):
    rows = alignment.alignments(documents([(1, "with ▁ inside"), (2, "plain")])).collect()
    assert {r.doc_id: r.n_a for r in rows} == {1: 0, 2: 1}
    assert {r.doc_id: r.groups for r in rows}[1] == ""


def test_long_text_and_repeated_ids(documents, tools):
    long = "Some words, naïve ones — and 日本 too.\n" * 3000
    pairs = [(None, "a b"), (5, "twice"), (5, "twice"), (6, long), (None, None)]
    rows = alignment.digests(documents(pairs)).collect()
    a, b = tools
    by = {(r.doc_id, r.n_a, r.n_b) for r in rows}
    assert len(rows) == 5
    assert (6, len(a.encode(" " + long, add_special_tokens=False).ids), len(b.encode(long))) in by
    assert [r.groups_sha256 for r in rows if r.doc_id == 5][0] == [r.groups_sha256 for r in rows if r.doc_id == 5][1]


def test_vocabulary_bytes_are_the_librarys():
    side = alignment.ByteSide(A_PATH)
    byte = byte_names()
    vocabulary = side.tokenizer.get_vocab()
    for token, i in list(vocabulary.items())[::97]:
        if token != "<|endoftext|>":
            start, n = side.vocabulary.starts[i], side.vocabulary.lengths[i]
            assert side.vocabulary.data[start : start + n].tobytes() == bytes(byte[c] for c in token)


def test_empty_table(documents):
    assert alignment.digests(documents([])).collect() == []
