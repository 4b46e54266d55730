"""Dual-tree search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import topk


def brute(rows, every, k):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=d)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # one very common vector
    rows += [(2000, None), (2001, []), (2002, [None] * d), (2003, [float("nan")] * d), (2004, [float("inf")] * d)]
    rows += [(None, rows[1][1]), (2010, [1.0, 2.0]), (2020, [0.5, -2.0]), (2030, [0.0] * d), (20, rows[20][1]), (20, rows[5][1])]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("block,leaf", [(8192, 24), (64, 3)])
def test_equals_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", max(block // 8, 4))
    monkeypatch.setattr(topk, "LEAF", leaf)
    rows = vectors(block, 400, 8)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("x"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(frame, 10, 7).collect())
    assert got == brute(rows, 10, 7)


def test_few_candidates_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0], 1)], schema)).collect() == []
    two = spark.createDataFrame([(0, [1.0], 1), (7, [-0.5], 2)], schema)
    assert [tuple(r) for r in topk.top_k(two).collect()] == [(0, 1, 7, -512 * 1024)]


def test_large_numbers_stay_exact():
    points = np.array([[2**40 + 1, 3], [2**40, 5], [2**40 - 1, -7]], dtype=np.int64)
    (ids, scores), = topk.search(points[:1], points, np.array([1, 2, 3]), np.array([1]), 5)
    assert ids.tolist() == [2, 3]
    assert [int(x) for x in scores] == [(2**40 + 1) * 2**40 + 15, (2**40 + 1) * (2**40 - 1) - 21]


def test_cover_tree_holds_every_point_within_its_radius():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 5))
    tree = topk.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(500))
    for node in range(len(tree.centre)):
        rows = tree.order[tree.first[node] : tree.last[node]]
        away = np.sqrt(((points[rows] - points[tree.centre[node]]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[node] + 1e-9


def test_copies_of_a_query_do_not_take_the_places_of_equal_vectors(spark):
    rows = [(100, [1.0, 0.5])] * 16 + [(101 + i, [1.0, 0.5]) for i in range(39)] + [(200 + i, [0.5, 0.1 * i]) for i in range(1, 9)]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == brute(rows, 100, 10)
    assert [v for q, _, v, _ in got if q == 100] == list(range(101, 111))


def test_points_without_clusters_are_pooled_and_searched_exactly():
    rng = np.random.default_rng(7)
    points = rng.integers(-600, 600, size=(2000, 64))
    points = np.concatenate([points, points[:5], points[7] + rng.integers(-3, 3, size=(300, 64))])  # and copies, and one cluster
    tree = topk.CoverTree(np.unique(points, axis=0).astype(float))
    assert len(tree.centre) < 100  # not a node for each point, met one at a time
    ids = rng.permutation(len(points))
    got = topk.search(points[:40], points, ids, ids[:40], 10)
    for i, (found, scores) in enumerate(got):
        best = sorted((-int(s), int(j)) for s, j in zip(points[i] @ points.T, ids) if j != ids[i])[:10]
        assert [(-int(s), int(j)) for s, j in zip(scores, found)] == best
