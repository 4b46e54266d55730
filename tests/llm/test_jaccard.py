"""The n-gram Jaccard join against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threadsift.llm import jaccard
from threadsift.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(pairs, percent=80):
    sets = [shingle_set(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(pairs)):
        groups.setdefault(root(i), []).append(pairs[i][0])
    least = {r: min([g for g in ids if g is not None], default=None) for r, ids in groups.items()}
    return sorted([(pairs[i][0], len(sets[i]), least[root(i)]) for i in range(len(pairs))], key=repr)


def corpus(seed, n=90):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "Ab", "aB"]
    passage = rng.choices(words, k=12)
    bases = [rng.choices(words, k=rng.randint(8, 90)) for _ in range(8)]
    pairs = []
    for i in range(n):
        if rng.random() < 0.6:
            w = list(rng.choice(bases))
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = rng.choices(words, k=rng.randint(0, 60))
        if rng.random() < 0.3:
            w = w + passage
        pairs.append((i, " ".join(w)))
    pairs += [(200, None), (201, ""), (202, "one two"), (203, "ONE  two\n"), (204, " \t"), (205, "x " * 50), (206, "x " * 60)]
    return pairs


def got(frame, **kw):
    return sorted([tuple(r) for r in jaccard.similar(frame, **kw).collect()], key=repr)


@pytest.mark.parametrize("seed,block,cell,common", [(1, 64, 20_000, 100_000), (2, 2, 5, 100_000), (3, 2, 3, 0)])
def test_equals_brute_force(documents, monkeypatch, seed, block, cell, common):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "COMMON", max(common, 1))
    pairs = corpus(seed)
    assert got(documents(pairs)) == brute(pairs)


def test_without_leaders_every_link_comes_from_the_index(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "VOTES", jaccard.HASHES + 1)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    pairs = corpus(4)
    assert got(documents(pairs)) == brute(pairs)


def test_repeated_and_missing_ids_and_empty_tables(documents):
    text = "a b c d e f g h"
    pairs = [(None, text), (3, text), (3, text), (3, "other words"), (None, None), (1, "")]
    assert got(documents(pairs)) == brute(pairs)
    assert got(documents([])) == []


def test_one_document_of_each_class_stays(documents):
    pairs = corpus(5)
    frame = documents(pairs, {"k": F.lit(0), "class": F.lit("c"), "n": F.lit(1)})
    kept = jaccard.representatives(frame)
    assert kept.columns == frame.columns
    want = {c for i, n, c in brute(pairs)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 4), (7, 8), (8, 8), (5, 6), (6, 5), (20, 19), (19, 18), (18, 17)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 7: 7, 8: 7, 5: 5, 6: 5, 17: 17, 18: 17, 19: 17, 20: 17}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bitmaps_never_turn_a_link_away():
    """(na + nb - different bits) / 2 is never less than what two sets share."""
    import numpy as np

    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**64, rng.integers(1, 400), dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate([base[: rng.integers(0, len(base) + 1)], rng.integers(0, 2**64, rng.integers(0, 50), dtype=np.uint64)]))]
    sets.append(np.zeros(0, dtype=np.uint64))
    bits = jaccard.bitmaps(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    turned = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b))
            most = (len(a) + len(b) - int(np.bitwise_count(bits[i] ^ bits[j]).sum())) // 2
            assert most >= shared
            turned += most < min(len(a), len(b))
    assert turned > 1000 and not bits[-1].any()


def test_bitmaps_of_large_sets_turn_near_misses_away():
    """At similarity 0.6 no pair of large sets is written; 256 places let all of them through."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 900, dtype=np.uint64)
    sets = [np.sort(np.concatenate([base, rng.integers(0, 2**64, 300, dtype=np.uint64)])) for _ in range(12)]
    bits = jaccard._bitmaps_by_size(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    shared = np.sort(base)[:220]
    rows = pa.RecordBatch.from_pydict(
        {"k": range(12), "n": [1200] * 12, "class": range(12), "meeting": [0] * 12, "prefix": [shared.tobytes()] * 12, "bits": bits},
        pa.schema([("k", pa.int64()), ("n", pa.int32()), ("class", pa.int64()), ("meeting", pa.int32()), ("prefix", pa.binary()), ("bits", pa.binary())]),
    )
    none = np.zeros(0, dtype=np.uint64)
    packed = jaccard._postings(none, none.astype(np.int64), 1, 20_000, True)(iter([rows]))
    assert sum(b.num_rows for b in jaccard._probe(80)(packed)) == 0
    near = [s[: 1150] for s in sets[:1]] + [sets[0]]
    bits = jaccard._bitmaps_by_size(np.concatenate(near), np.cumsum([0, 1150, 1200]))
    rows = rows.slice(0, 2).set_column(5, "bits", pa.array(bits, pa.binary())).set_column(1, "n", pa.array([1150, 1200], pa.int32()))
    packed = jaccard._postings(none, none.astype(np.int64), 1, 20_000, True)(iter([rows]))
    assert sum(b.num_rows for b in jaccard._probe(80)(packed)) == 1  # a link stays
