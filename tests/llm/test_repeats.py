"""Word and byte deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import hashing, repeats, substring_dedup, suffix_dedup
from threadsift.llm.windows import super_kmers


def brute_words(pairs, size):
    pairs = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in pairs]
    count = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(pairs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def brute_bytes(pairs, size):
    pairs = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
    seen, out = set(), []
    for doc_id, text in pairs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - size + 1):
            piece = raw[i : i + size]
            if piece in seen:
                gone[i : i + size] = True
            seen.add(piece)
        gone = gone[:-1]
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def corpus(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "gamma", "delté", "ß", "x", "lorem", "ipsum", "zwölf"] + [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(20, 60))) for _ in range(4)]
    pairs = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 50))) for _ in range(rng.randint(0, 3))]
        parts += [rng.choice(passages)] * rng.randint(0, 2)
        rng.shuffle(parts)
        pairs.append((i * 3, "\n".join(parts)))
    pairs += [(1, "a " * 300), (2, "ab" * 300), (4, None), (5, ""), (7, " \n\t "), (8, passages[0] * 2)]
    pairs += [(10, pairs[3][1]), (11, pairs[3][1])]
    return pairs


ODD = [(None, "x y z " * 30), (None, "x y z " * 30), (5, "q " * 90), (5, "q " * 90), (5, "other"), (None, None)]


@pytest.mark.parametrize("hot", [2, 200])
def test_words_equal_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    pairs = corpus(hot)
    assert order(substring_dedup.digests(documents(pairs), 12, 3).collect()) == order(brute_words(pairs, 12))


@pytest.mark.parametrize("hot", [2, 200])
def test_bytes_equal_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    pairs = corpus(hot + 1)
    assert order(suffix_dedup.digests(documents(pairs), 60, 9).collect()) == order(brute_bytes(pairs, 60))


def test_repeated_and_missing_ids_are_documents_of_their_own(documents):
    assert order(substring_dedup.digests(documents(ODD), 35).collect()) == order(brute_words(ODD, 35))
    assert order(suffix_dedup.digests(documents(ODD), 100).collect()) == order(brute_bytes(ODD, 100))


def test_empty_table(documents):
    assert substring_dedup.digests(documents([])).collect() == []
    assert suffix_dedup.digests(documents([])).collect() == []
    assert suffix_dedup.without_repeats(documents([])).collect() == []


def test_clashing_columns_and_cut_characters(documents):
    long = "é" * 60
    pairs = [(1, "a" + long + "b"), (2, "é" + long[:-4] + "zz"), (3, None)]
    frame = documents(pairs, {"k": F.lit(1), "row": F.lit("r"), "spans": F.lit(2), "start": F.lit(0)})
    rows = {r.doc_id: r for r in suffix_dedup.without_repeats(frame).collect()}
    assert rows[1].text is not None and rows[3].text is None and rows[1].row == "r"
    assert rows[2].text.endswith("zz") and len(rows[2].text.encode()) < 20
    assert set(suffix_dedup.without_repeats(frame).columns) == set(frame.columns)


def test_super_kmers_cover_every_window_once():
    rng = np.random.default_rng(3)
    symbols = hashing.mix(rng.integers(0, 4, 500).astype(np.uint64))
    bounds = np.array([0, 0, 7, 200, 211, 500])
    runs = super_kmers(symbols, bounds, 20, 5)
    got = sorted((r, s + i) for r, s, c in zip(runs.row, runs.start, runs.count) for i in range(c))
    want = [(r, s) for r in range(5) for s in range(bounds[r + 1] - bounds[r] - 19)]
    assert got == want


def test_shallow_sort_and_blind_tries_find_all_equal_suffixes():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[200:600]
    data[2000:2300] = 97
    at = np.arange(2900)
    found = {tuple(sorted(c)) for c in suffix_dedup.equal_suffixes(data, at, 60, 16)}
    groups = {}
    for i in at.tolist():
        groups.setdefault(data[i : i + 60].tobytes(), []).append(i)
    assert found == {tuple(v) for v in groups.values() if len(v) > 1}


def test_second_hash_does_not_follow_from_the_first():
    """Windows that the first hash cannot tell apart are told apart by the second."""
    import numpy as np

    from threadsift.llm import hashing

    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 8, dtype=np.uint64)
    y = x.copy()
    # One step up in a symbol and one base step down in the one before leaves the polynomial as it is.
    y[4] += np.uint64(1)
    y[3] -= np.uint64(hashing._BASE)
    first = [hashing.Rolling(v).windows(8) for v in (x, y)]
    second = [hashing.Rolling.second(v).windows(8) for v in (x, y)]
    assert first[0] == first[1] and second[0] != second[1]


def test_texts_come_to_a_worker_in_small_batches(documents, monkeypatch):
    from threadsift.llm import repeats, suffix_dedup
    from threadsift.llm.common import keyed

    made = repeats._runs

    def runs(kind, keys_only):
        inner = made(kind, keys_only)

        def run(batches):
            def seen():
                for rows in batches:
                    assert rows.num_rows <= 2000
                    yield rows

            yield from inner(seen())

        return run

    monkeypatch.setattr(repeats, "_runs", runs)
    text = "one string that is long enough to be found again because it has more than a hundred bytes, which is what counts"
    frame = documents([(i, text if i % 1000 == 0 else "short") for i in range(5000)]).coalesce(1)
    spans = suffix_dedup.repeated_spans(keyed(frame))
    assert sorted({r.k for r in spans.collect()}) == [1000, 2000, 3000, 4000]
