"""Ranking and numbering that survive one key holding a large share of all rows.

A plain window sorts a whole key in one task. The helpers here either reduce each
key on the map side, or cut keys into slices whose size does not follow the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_N_SALTS = 64


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest `order` per key; partial results merge before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in others])
    )


def first_n_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread_by: str
) -> DataFrame:
    """The first n rows of every key.

    Two rounds of `row_number() <= n`: the first over salted keys, so that at most
    n rows per key and salt meet in the second.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(FIRST_N_SALTS)))
    for partition in ([*keys, "_salt"], list(keys)):
        window = Window.partitionBy(*partition).orderBy(*order)
        salted = salted.withColumn("_position", F.row_number().over(window)).filter(F.col("_position") <= n)
    return salted.drop("_salt", "_position")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition &= left[key].eqNullSafe(renamed[f"_right_{key}"])
    return left.join(renamed, condition).drop(*[f"_right_{key}" for key in keys])


def numbered(
    rows: DataFrame,
    keys: Sequence[str],
    slice_by: Column,
    order: Sequence[Column],
    name: str = "row_no",
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Exact 1-based position of each row inside its key.

    `slice_by` must not decrease along `order`. Rows are sorted per (key, slice);
    the sizes of the earlier slices, counted on the map side, give the offset.
    NULL is a key and a slice like any other. Columns of `per_key` (one row per key)
    travel with the offsets, so attaching them moves no row a second time; rows whose
    key it lacks are dropped.
    """
    sliced = rows.withColumn("_slice", slice_by)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    if per_key is not None:
        offsets = _null_safe_join(offsets, per_key, list(keys))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered_inside = sliced.withColumn("_inside", F.row_number().over(inside))
    return (
        _null_safe_join(numbered_inside, offsets, [*keys, "_slice"])
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_inside", "_offset")
    )


def hash_order(column: str) -> tuple[Column, list[Column]]:
    """(slice, order) for an order with no meaning of its own: by digest of a unique column.

    Digests spread evenly, so the 4096 slices of a hot key are of equal size.
    """
    digest = F.md5(F.col(column).cast("string"))
    return F.substring(digest, 1, 3), [digest, F.col(column)]


def in_chunks(rows: DataFrame, keys: Sequence[str], unique: str, size: int, name: str = "chunk_no") -> DataFrame:
    """Number the rows of each key into chunks of `size`; only a key's last chunk may be shorter."""
    if size <= 0:
        raise ValueError(f"chunk size must be positive: {size}")
    slice_by, order = hash_order(unique)
    return (
        numbered(rows, keys, slice_by, order, "_no")
        .withColumn(name, F.floor((F.col("_no") - 1) / F.lit(size)).cast("bigint"))
        .drop("_no")
    )
