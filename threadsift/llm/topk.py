"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are turned into whole numbers and dealt out in blocks; a task holds one block of
candidates and one block of queries. Both are indexed: a cover tree over the candidates,
another over the queries. The two are walked together. For a query node with centre c and
covering radius r and a candidate node with centre d and radius s, no inner product below
the pair exceeds

    <c, d> + s * |c| + r * |d| + r * s

so the pair is pruned when that is less than the worst kth score of the query node's
queries. What is left meets at the leaves, where scores are computed exactly. The best k
of all blocks are merged by rank.

Where points lie so far apart that hardly any two share a ball, as in many dimensions
without clusters, they are not made nodes one by one: they are pooled in leaves around the
centre they have in common, sorted by their distance from it, and a leaf's queries meet all
of its points in one product.

Equal vectors are one point of a tree. Every row is indexed and every query is answered
exactly, so recall is 1.

Edge cases: vectors that are null, empty, or hold a null or a value that is not finite take no
part, as queries or candidates; neither do rows without a vec_id. Vectors meet only vectors
of the same number of components. Rows that repeat a vec_id are candidates each, and a query
for each different vector. Rows with a query's vec_id are no candidates of it.
Fewer than k candidates give fewer rows. A score beyond 64 bits is
returned as the end of their range. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
EVERY = 100
LEAF = 24
#: Centres in a row that take hardly any point after which a node's points left over are pooled, and points of a pooled leaf.
PATIENCE = 32
POOL = 256
#: Rows of a block of candidates and of queries.
BLOCK = 8192
QUERY_BLOCK = 2048


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null for vectors that take no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * scale)))


class CoverTree:
    """Nodes as arrays: centre, covering radius, children, and the run of points below.

    Built level by level: the points of a node within half its level's reach of the centre
    stay with it, each point left over in turn becomes the centre of a sibling that takes
    the points in its own reach. A node of few points is a leaf. Points whose ball would hold
    next to nothing else, and what is left after PATIENCE such in a row, are pooled in leaves
    around the node's own centre.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.empty(len(points), dtype=np.int64)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.filled = 0
        if len(points):
            rows = np.arange(len(points))
            away = self._distances(rows, 0)
            self._build(0, rows, away, float(away.max()))
        self.centre_rows = np.array(self.centre, dtype=np.int64)
        self.radii = np.array(self.radius)

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        difference = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", difference, difference))

    def _node(self, centre: int, away: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(away.max()) if len(away) else 0.0)
        self.children.append([])
        self.first.append(self.filled)
        self.last.append(0)
        return len(self.centre) - 1

    def _fill(self, node: int, rows: np.ndarray) -> int:
        self.order[self.filled : self.filled + len(rows)] = rows
        self.filled += len(rows)
        self.last[node] = self.filled
        return node

    def _build(self, centre: int, rows: np.ndarray, away: np.ndarray, reach: float) -> int:
        node = self._node(centre, away)
        if len(rows) <= LEAF or self.radius[node] == 0:
            return self._fill(node, rows)
        reach = min(reach, self.radius[node]) / 2
        near = away <= reach
        below = [(centre, rows[near], away[near])]
        rest, far = rows[~near], away[~near]
        pooled, poor = [], 0
        while len(rest) and poor < PATIENCE:
            own = self._distances(rest, int(rest[0]))
            taken = own <= reach
            if np.count_nonzero(taken) <= max(LEAF // 4, 1):
                poor += 1
                pooled.append((rest[taken], far[taken]))
            else:
                poor = 0
                below.append((int(rest[0]), rest[taken], own[taken]))
            rest, far = rest[~taken], far[~taken]
        for c, r, a in below:
            self.children[node].append(self._build(c, r, a, reach))
        rest, far = (np.concatenate(x) for x in zip(*pooled, (rest, far)))
        order = np.argsort(far, kind="stable")
        for i in range(0, len(rest), POOL):
            part = order[i : i + POOL]
            self.children[node].append(self._fill(self._node(centre, far[part]), rest[part]))
        self.last[node] = self.filled
        return node


def search(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best points: greater scores, then lesser ids.

    ids: of each point; own: the id that is no candidate of a query. Whole numbers whose
    products sum to less than 2^53 are exact as doubles; others are computed as Python's.
    """
    exact = float
    d = queries.shape[1]
    if max(int(np.abs(queries).max(initial=1)), 1) * max(int(np.abs(points).max(initial=1)), 1) * d >= 2**53:
        exact = object
    distinct, group = np.unique(points, axis=0, return_inverse=True)
    by_group = np.lexsort((ids, group.ravel()))
    starts = np.searchsorted(group.ravel()[by_group], np.arange(len(distinct) + 1))
    sorted_ids = ids[by_group]
    tree, query_tree = CoverTree(distinct.astype(float)), CoverTree(queries.astype(float))
    lengths = np.sqrt((tree.points[tree.centre_rows] ** 2).sum(axis=1)) if len(distinct) else np.zeros(0)
    centres = tree.points[tree.centre_rows]
    asked, points_ = queries.astype(exact), distinct.astype(exact)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, exact)) for _ in queries]
    worst = np.full(len(queries), -np.inf)

    def bounds(node: int, nodes: np.ndarray) -> np.ndarray:
        c, r = query_tree.points[query_tree.centre[node]], query_tree.radius[node]
        s = tree.radii[nodes]
        value = centres[nodes] @ c + s * np.sqrt(c @ c) + r * lengths[nodes] + r * s
        return value + 1e-9 * (np.abs(value) + 1)

    def own_rows(g: int, own_id: int) -> int:
        """Rows of a group of more than k equal vectors that have this id."""
        run = sorted_ids[starts[g] : starts[g + 1]]
        return int(np.searchsorted(run, own_id, "right") - np.searchsorted(run, own_id)) if len(run) > k else 0

    def meet(rows: np.ndarray, node: int) -> None:
        """All queries `rows` against all points of a leaf."""
        at = tree.order[tree.first[node] : tree.last[node]]
        scores = asked[rows] @ points_[at].T
        high = (scores >= worst[rows][:, None]).astype(bool)
        for i in np.flatnonzero(high.any(axis=1)).tolist():
            row, good = rows[i], np.flatnonzero(high[i])
            # Of equal vectors no more than the first k ids besides the query's own can count.
            runs = [by_group[starts[g] : min(starts[g + 1], starts[g] + k + own_rows(g, own[row]))] for g in at[good].tolist()]
            found = ids[np.concatenate(runs)]
            value = np.repeat(scores[i][good], [len(x) for x in runs])
            other = found != own[row]
            found, value = np.concatenate([best[row][0], found[other]]), np.concatenate([best[row][1], value[other]])
            order = (np.lexsort((found, -value)) if exact is float else sorted(range(len(found)), key=lambda j: (-value[j], found[j])))[:k]
            best[row] = found[order], value[order]
            if len(order) == k:
                worst[row] = float(value[order[-1]])

    def opened(node: int, nodes: np.ndarray, rows: np.ndarray, least: float) -> np.ndarray:
        """Candidate nodes that stay, those wider than `least` replaced by their children, again and again."""
        while len(nodes):
            nodes = nodes[bounds(node, nodes) >= worst[rows].min()]
            wide = np.array([bool(tree.children[n]) for n in nodes.tolist()], dtype=bool) & (tree.radii[nodes] > least)
            if not wide.any():
                break
            nodes = np.concatenate([nodes[~wide], *(np.array(tree.children[n]) for n in nodes[wide].tolist())])
        return nodes

    def walk(node: int, nodes: np.ndarray) -> None:
        rows = query_tree.order[query_tree.first[node] : query_tree.last[node]]
        if query_tree.children[node]:
            nodes = opened(node, nodes, rows, query_tree.radius[node])
            for child in query_tree.children[node]:
                walk(child, nodes)
            return
        # The most promising leaf first: it raises the worst scores before the rest is opened.
        top = None
        below = nodes
        while len(below):
            top = int(below[np.argmax(bounds(node, below))])
            below = np.array(tree.children[top], dtype=np.int64)
        if top is not None:
            meet(rows, top)
        nodes = opened(node, nodes, rows, -1.0)
        upper = bounds(node, nodes)
        for i in np.argsort(-upper).tolist():
            if upper[i] >= worst[rows].min() and nodes[i] != top:
                meet(rows, int(nodes[i]))

    if len(distinct) and len(queries):
        walk(0, np.array([0]))
    return best


def _blocks(k: int):
    def run(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(points):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "query", "vec_id", "score")})
        found = search(np.stack(queries["v"]), np.stack(points["v"]), points["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), k)
        sizes = [len(f[0]) for f in found]
        return pd.DataFrame(
            {
                "query_id": np.repeat(queries["vec_id"].to_numpy(), sizes),
                "query": np.repeat(queries["query"].to_numpy(), sizes),
                "vec_id": np.concatenate([f[0] for f in found]),
                "score": np.array([min(max(int(x), -(2**63)), 2**63 - 1) for f in found for x in f[1]], dtype=np.int64),
            }
        )

    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose vec_id `every` divides."""
    rows = vectors.filter("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long"), whole_numbers(F.col("embedding"), scale).alias("v")
    )
    rows = rows.filter("v IS NOT NULL").withColumn("d", F.size("v"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    n_blocks, n_queries = -(-max(counts["n"], 1) // BLOCK), -(-max(counts["q"], 1) // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("v", "vec_id"), F.lit(n_queries)).cast("int")
    # Each block of queries meets each block of candidates in a task of its own.
    points = rows.withColumns({"b": block, "qb": F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))})
    asked = queries.withColumns({"qb": query_block, "b": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))})
    asked = asked.withColumn("query", F.xxhash64("vec_id", "v")).dropDuplicates(["query", "b"])
    keys = ["d", "qb", "b"]
    found = asked.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(_blocks(k), "query_id long, query long, vec_id long, score long")
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
