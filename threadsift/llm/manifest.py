"""Merkle manifest of a dataset, with proofs by checkpoint and recompute.

Every row is a leaf: the SHA-256 of its fields. The leaves of a partition (`lang`) in
order of doc_id are the lowest level of a tree in which every ARITY consecutive nodes
become the digest of their digests, until one is left, the partition's subroot. The
subroots in order of their partitions are the leaves of one more tree, whose top is the
root of the dataset.

Only every STRIDE-th level is written: one row for each aligned subtree of STRIDE
levels, which holds the up to ARITY^STRIDE digests at its bottom. Its other nodes exist
only while they are needed: once to compute its top, and once more when proofs are
taken. Proofs go down from the root: a subtree's row meets the proof of its top,
regenerates its interior nodes from the stored digests, emits for each bottom digest the
siblings on every level with the top's proof behind them, and forgets the interior. The
proofs of one level are the input of the next lower one, so a leaf's proof appears only
at the end, beside its leaf, and is never written or shuffled: what moves is one upper
proof for each subtree.

All nodes are hexadecimal text. Leaves are sorted by range into partitions of even size
and written; exact positions come from the counted sizes of the earlier ranges, so a
partition that holds most rows is no task of its own. Each level's rows are 1/512 of the
one below, and every step is a table in the shared folder that a lost executor can read again.

Edge cases: a null field is `-`, so it differs from an empty one and from the text "-",
which is `1:-`. A null partition comes first and is not the empty one. Rows that repeat a
doc_id, or have none, are ordered by digest (nulls first), so the result does not depend on
how the table is cut; equal rows are leaves of their own with equal digests. A partition
of one row has its leaf as subroot; one subroot is the root. An empty table gives an
empty result. Columns other than the fields are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.common import materialize

ARITY = 8
STRIDE = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A proof: for each level from the bottom, the joined digests left and right of the node.
STEPS = "array<struct<before: string, after: string>>"


def framed(value: Column) -> Column:
    """A field as it enters a leaf: `-`, or its UTF-8 byte count, a colon, its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _ordered_key(partition: Column) -> Column:
    """A text that is never null and sorts as the partitions do, null first."""
    return F.when(partition.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), partition.cast("string")))


def positioned(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with `position`, from 0 in each `key` in the given order of columns, and `n`, the key's rows; written once.

    The last word on the order has an arbitrary number, which only spreads rows that are
    equal in everything else.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    columns = ["key", *[F.col(c).asc_nulls_first() for c in order], "_tie"]
    ranged = rows.withColumn("_tie", tie).repartitionByRange(*columns).sortWithinPartitions(*columns)
    cut = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()))
    # One row for each range and key in it: at most ranges + keys, whatever the rows.
    sizes = cut.groupBy("key", "_range").agg(F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_first"))
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "key", "_range", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_size").over(whole).alias("n")
    )
    placed = cut.join(offsets, ["key", "_range"])
    return placed.withColumn("position", F.col("_id") + F.col("_shift")).drop("_id", "_shift", "_range", "_tie")


def _runs(digests: Column, work) -> Column:
    """work(run, place) for the runs of ARITY digests, in order; place is the run's number."""
    last = F.floor((F.size(digests) - 1) / F.lit(ARITY)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda j: work(F.slice(digests, j * ARITY + 1, F.lit(ARITY)), j))


def _above(digests: Column) -> Column:
    """The next level: the digest of each run."""
    return _runs(digests, lambda run, _: F.sha2(F.array_join(run, ""), 256))


def _steps(digests: Column) -> Column:
    """For each digest of a level, what stands left and right of it in its run."""

    def of_run(run: Column, _: Column) -> Column:
        return F.transform(
            run,
            lambda _, i: F.struct(
                F.array_join(F.slice(run, F.lit(1), i), "").alias("before"),
                F.array_join(F.slice(run, i + 2, F.lit(ARITY)), "").alias("after"),
            ),
        )

    return F.flatten(_runs(digests, of_run))


def _is_top(nodes: Column) -> Column:
    """A key's whole tree ends with one node; a part of a tree rises STRIDE levels, with one node too."""
    return F.col("ends") & (F.size(nodes) == 1)


class Tree:
    """The stored levels of the trees of all keys, lowest first.

    Every level has key, subtree, n (leaves of the key), ends and rows: one row for each
    aligned subtree of STRIDE levels, rows being its bottom nodes in order, each with
    `digest` (and what else the leaves carry). `ends` tells that the subtree holds all nodes
    of its key, so that the tree stops at its top.
    """

    def __init__(self, leaves: DataFrame, carried: Sequence[str] = ()):
        """leaves: key, position, n, digest and the carried columns."""
        self.width = ARITY**STRIDE
        self.carried = list(carried)
        self.levels = [materialize(self._grouped(leaves, ["digest", *carried], self.width))]
        most = self.levels[0].agg(F.max("n")).first()[0] or 0
        reach = self.width
        while reach < most:
            reach *= self.width
            risen = self._tops(self.levels[-1].filter("NOT ends"))
            self.levels.append(materialize(self._grouped(risen.withColumnRenamed("subtree", "position"), ["digest"], reach)))

    def _grouped(self, nodes: DataFrame, columns: list[str], reach: int) -> DataFrame:
        """Nodes by subtree; a subtree's top stands for `reach` leaves."""
        subtree = F.floor(F.col("position") / F.lit(self.width)).cast("long")
        collected = F.array_sort(F.collect_list(F.struct("position", *columns)))
        rows = nodes.groupBy("key", subtree.alias("subtree")).agg(F.max("n").alias("n"), collected.alias("rows"))
        bare = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in columns]))
        return rows.select("key", "subtree", "n", (F.col("n") <= reach).alias("ends"), bare.alias("rows"))

    def _tops(self, level: DataFrame) -> DataFrame:
        """key, subtree, n, digest of the subtrees' tops; all else of their interior is forgotten."""
        rows = level.select("key", "subtree", "n", "ends", F.transform("rows", lambda r: r["digest"]).alias("nodes0"))
        for depth in range(STRIDE):
            nodes = F.col(f"nodes{depth}")
            rows = rows.withColumn(f"nodes{depth + 1}", F.when(_is_top(nodes), nodes).otherwise(_above(nodes)))
        return rows.select("key", "subtree", "n", F.col(f"nodes{STRIDE}")[0].alias("digest"))

    def roots(self) -> DataFrame:
        """key, digest of the top of every key's tree."""
        return reduce(DataFrame.unionByName, [self._tops(level.filter("ends")).select("key", "digest") for level in self.levels])

    def proofs(self, upper: DataFrame) -> DataFrame:
        """key, position, digest, the carried columns, steps for every leaf, and what `upper` says of its key.

        upper: key, steps (the proof of the key's top, empty for a root) and any other columns.
        """
        extra = [c for c in upper.columns if c not in ("key", "steps")]
        tops = upper.withColumnRenamed("steps", "top_steps")
        above: DataFrame | None = None  # key, subtree, steps of the nodes one stored level up
        for number in range(len(self.levels) - 1, -1, -1):
            level = self.levels[number]
            joined = level.filter("ends").join(tops, "key")
            if above is not None:
                joined = joined.unionByName(level.filter("NOT ends").join(above, ["key", "subtree"]))
            rows = self._opened(joined, ["digest", *(self.carried if number == 0 else [])], extra)
            if number == 0:
                return rows
            above = materialize(rows.select("key", F.col("position").alias("subtree"), F.col("steps").alias("top_steps"), *extra))

    def _opened(self, joined: DataFrame, keep: list[str], extra: list[str]) -> DataFrame:
        """Regenerate the interior of each subtree and give every bottom node its steps up to the root."""
        rows = joined.select("key", "subtree", "ends", "rows", "top_steps", *extra, F.transform("rows", lambda r: r["digest"]).alias("nodes0"))
        for depth in range(STRIDE):
            nodes = F.col(f"nodes{depth}")
            rows = rows.withColumn(f"steps{depth}", F.when(_is_top(nodes), F.array().cast(STEPS)).otherwise(_steps(nodes)))
            rows = rows.withColumn(f"nodes{depth + 1}", F.when(_is_top(nodes), nodes).otherwise(_above(nodes)))

        def step(depth: int, i: Column) -> Column:
            place = F.floor(i / F.lit(ARITY**depth)).cast("int")
            steps = F.col(f"steps{depth}")
            return F.when(F.size(steps) == 0, F.array().cast(STEPS)).otherwise(F.array(F.get(steps, place)))

        opened = rows.select(
            "key",
            (F.col("subtree") * self.width).alias("_first"),
            *extra,
            "top_steps",
            *[f"steps{d}" for d in range(STRIDE)],
            F.posexplode("rows").alias("_at", "_row"),
        )
        return opened.select(
            "key",
            (F.col("_first") + F.col("_at")).alias("position"),
            *[F.col("_row")[c].alias(c) for c in keep],
            *extra,
            F.concat(*[step(d, F.col("_at")) for d in range(STRIDE)], F.col("top_steps")).alias("steps"),
        )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def proofs(documents: DataFrame, claimed: Column | None = None, fields: Sequence[str] = FIELDS, partition: str = "lang", order: str = "doc_id") -> DataFrame:
    """doc_id, leaf, claimed, subroot, root, steps for every row.

    `claimed` is a leaf computed by someone who may hold other data, by default the leaf itself.
    """
    leaf = leaf_of(*[F.col(f"`{f}`") for f in fields])
    leaves = documents.select(
        F.col(f"`{order}`").alias("doc_id"), leaf.alias("digest"), (leaf if claimed is None else claimed).alias("claimed"), _ordered_key(F.col(f"`{partition}`")).alias("key")
    )
    tree = Tree(positioned(leaves, ["doc_id", "digest"]), ["doc_id", "claimed"])
    subroots = materialize(tree.roots().select("key", F.col("digest").alias("subroot")))
    # The partitions are the leaves of one more tree, under a key that is the same for all.
    parts = positioned(subroots.select(F.lit("").alias("key"), F.col("key").alias("part"), F.col("subroot").alias("digest")), ["part"])
    top = Tree(parts, ["part"])
    root = top.roots().select("key", F.col("digest").alias("root"), F.array().cast(STEPS).alias("steps"))
    upper = materialize(top.proofs(root).select(F.col("part").alias("key"), F.col("digest").alias("subroot"), "root", "steps"))
    return tree.proofs(upper).select("doc_id", F.col("digest").alias("leaf"), "claimed", "subroot", "root", "steps")


def tampered(documents: DataFrame) -> Column:
    """The leaf of a row, its text with A-Z lowered where 3 divides the CRC-32 of its doc_id."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(chosen, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    return leaf_of(*[text if f == "text" else F.col(f) for f in FIELDS])


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every document."""
    rows = proofs(documents, tampered(documents))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded(F.col("claimed"), F.col("steps")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of a decimal number, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
 lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"""


def _framed_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR) END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_framed_sql(text if f == 'text' else f) for f in FIELDS)})"


def _levels_sql(name: str, leaves: str) -> str:
    """All levels of the trees of all keys: depth, key, position, digest, size (nodes of the level)."""
    return f"""{name}(depth, key, position, digest, size) AS ({leaves} UNION ALL
 SELECT any_value(depth) + 1, key, position // 8, sha256(string_agg(digest, '' ORDER BY position)), any_value((size + 7) // 8)
 FROM {name} WHERE size > 1 GROUP BY key, position // 8)"""


def _walk_sql(name: str, levels: str, start: str) -> str:
    """From every start upwards: id, key, depth, position, the siblings so far, the recomputed digest."""
    around = f"""(SELECT coalesce(string_agg(s.digest, '' ORDER BY s.position) FILTER (WHERE {{}}), '') FROM {levels} s
 WHERE s.key = w.key AND s.depth = w.depth AND s.position // 8 = w.position // 8)"""
    left, right = around.format("s.position < w.position"), around.format("s.position > w.position")
    return f"""{name}(id, key, depth, position, siblings, node) AS ({start} UNION ALL
 SELECT w.id, w.key, w.depth + 1, w.position // 8, w.siblings || {left} || {right}, sha256({left} || w.node || {right})
 FROM {name} w JOIN {levels} t ON t.key = w.key AND t.depth = w.depth AND t.position = w.position WHERE t.size > 1)"""


ORACLE = f"""
WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS key, {_leaf_sql('text')} AS leaf,
 CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf_sql('text')} END AS claimed,
 row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS position, count(*) OVER (PARTITION BY lang) AS size FROM documents),
{_levels_sql('levels', 'SELECT 0, key, position, leaf, size FROM leaves')},
subroots AS (SELECT key, digest, row_number() OVER (ORDER BY key) - 1 AS position, count(*) OVER () AS size FROM levels WHERE size = 1),
{_levels_sql('tops', "SELECT 0, '', position, digest, size FROM subroots")},
{_walk_sql('lower_walk', 'levels', "SELECT doc_id, key, 0, position, '', claimed FROM leaves")},
lower_done AS (SELECT w.id, w.siblings, w.node, s.position AS part, s.digest AS subroot FROM lower_walk w
 JOIN levels t ON t.key = w.key AND t.depth = w.depth AND t.position = w.position AND t.size = 1 JOIN subroots s ON s.key = w.key),
{_walk_sql('upper_walk', 'tops', "SELECT id, '', 0, part, siblings, node FROM lower_done")}
SELECT l.doc_id, l.leaf, d.subroot, t.digest AS root, sha256(w.siblings) AS proof_sha256, w.node AS folded_root, w.node = t.digest AS verified
FROM upper_walk w JOIN tops t ON t.depth = w.depth AND t.position = w.position AND t.size = 1 JOIN leaves l ON l.doc_id = w.id JOIN lower_done d ON d.id = w.id"""
