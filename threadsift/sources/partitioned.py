"""Tables in hash partitions of their key, of which a change reads and writes only those it touches.

    root/name/data/v=N/part=P/...   rows of partition P as version N left them
    root/name/parts/v=N             which version holds each partition: one row for each

Nothing is overwritten. A version first writes the partitions it changes, then its list,
in which the others keep the version they had; readers take the newest complete list, so
a job that dies half-way leaves files that nobody reads. A key's partition follows from
its hash alone, so equal keys always meet in the same one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators.mutations import upsert
from threadsift.session import materialize
from threadsift.sources.lookups import indexed
from threadsift.sources.tables import _children, versions

#: Changed keys up to this count are broadcast, so that the target is not moved at all.
BROADCAST_KEYS = 500_000

_PART = re.compile(r"^part=(\d+)$")


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def _list(spark: SparkSession, root: str, name: str) -> tuple[int, int, dict[int, int]]:
    """(version, number of partitions, version by partition) of the newest complete version; one row a partition."""
    known = versions(spark, root, f"{name}/parts")
    if not known:
        return 0, 0, {}
    rows = spark.read.parquet(f"{root}/{name}/parts/v={known[-1]}").collect()
    held = {r.part: r.version for r in rows if r.part >= 0}
    return known[-1], rows[0].parts, held


def _write(rows: DataFrame, root: str, name: str, keys: Sequence[str], parts: int, held: dict[int, int]) -> int:
    """Write rows by partition as the next version; partitions they do not touch stay as `held`."""
    spark = rows.sparkSession
    folder = f"{root}/{name}"
    taken = [int(c.split("=")[1]) for place in ("parts", "data") for c in _children(spark, f"{folder}/{place}") if c.startswith("v=")]
    version = max(taken, default=0) + 1
    placed = rows.withColumn("part", part_of(keys, parts))
    # The partitions are apart already where rows come from one; new rows are few or in all of them.
    indexed(placed.sortWithinPartitions("part", *keys), keys).partitionBy("part").parquet(f"{folder}/data/v={version}")
    written = [int(m.group(1)) for m in map(_PART.match, _children(spark, f"{folder}/data/v={version}")) if m]
    now = {**held, **dict.fromkeys(written, version)}
    # Part -1 says how many there are, also of an empty table.
    lines = [(-1, version, parts), *[(p, v, parts) for p, v in sorted(now.items())]]
    spark.createDataFrame(lines, "part int, version bigint, parts int").coalesce(1).write.parquet(f"{folder}/parts/v={version}")
    return version


def write_parts(rows: DataFrame, root: str, name: str, keys: Sequence[str], parts: int) -> int:
    """Write a whole table as its next version in `parts` partitions."""
    return _write(rows.repartition(parts, part_of(keys, parts)), root, name, keys, parts, {})


def _read(spark: SparkSession, root: str, name: str, held: dict[int, int], schema) -> DataFrame:
    paths = [f"{root}/{name}/data/v={v}/part={p}" for p, v in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, root: str, name: str, schema, only: Sequence[int] | None = None) -> DataFrame:
    """The newest version of a table, or only some of its partitions."""
    _, _, held = _list(spark, root, name)
    return _read(spark, root, name, held if only is None else {p: held[p] for p in only if p in held}, schema)


def upsert_parts(
    source: DataFrame, root: str, name: str, schema, keys: Sequence[str], update_columns: Sequence[str], as_of: Column
) -> int:
    """`mutations.upsert` as the next version; only partitions with keys of `source` are read and written.

    `source` holds one row for each key. Up to BROADCAST_KEYS rows, counted first, it is
    broadcast: target rows stay where they were read, for the update as for the search of
    keys that are there. A larger one meets the partitions it touches in a hash join.
    """
    spark = source.sparkSession
    _, parts, held = _list(spark, root, name)
    if not parts:
        raise ValueError(f"table {name} was not written in partitions yet")
    source = materialize(source)
    # At most as many rows as there are partitions.
    counts = source.groupBy(part_of(keys, parts).alias("part")).count().collect()
    if not counts:
        return _list(spark, root, name)[0]
    target = _read(spark, root, name, {r.part: held[r.part] for r in counts if r.part in held}, schema)
    if sum(r["count"] for r in counts) > BROADCAST_KEYS:
        return _write(upsert(target, source, keys, update_columns, as_of), root, name, keys, parts, held)
    present = target.select(*keys).join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    fresh = source.join(materialize(present), list(keys), "left_anti")
    changed = upsert(target, F.broadcast(source), keys, update_columns, as_of, how="left")
    added = upsert(target.limit(0), fresh, keys, update_columns, as_of)
    return _write(changed.unionByName(added), root, name, keys, parts, held)
