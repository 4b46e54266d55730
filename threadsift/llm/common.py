"""What several operators share: document keys, written intermediate tables, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift import session

#: With this on, Spark deletes the shuffle files of a statement when the statement ends.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(rows: DataFrame, **options: str) -> DataFrame:
    """Write a frame to the shared folder, drop the shuffle files it took, read it back."""
    conf = rows.sparkSession.conf
    before = conf.get(_CLEAN_UP, None)
    conf.set(_CLEAN_UP, "true")
    try:
        return session.materialize(rows, **options)
    finally:
        if before is None:
            conf.unset(_CLEAN_UP)
        else:
            conf.set(_CLEAN_UP, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m"):
    """Statements that run inside hand Python workers at most so many rows and bytes at once: less memory for wide rows."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def spread_pieces(text: Column, seed: Column, size: int, most: int) -> Column:
    """Up to `most` pieces of `size` characters, taken by hash from all over a text, in its order."""
    number = F.greatest(F.ceil(F.length(text) / F.lit(size)).cast("int"), F.lit(1))
    hashed = F.transform(F.sequence(F.lit(0), number - 1), lambda i: F.struct(F.xxhash64(seed, i).alias("h"), i.alias("i")))
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(hashed), 1, most), lambda x: x["i"]))
    return F.transform(chosen, lambda i: F.substring(text, i * size + 1, F.lit(size)))


#: What a Python worker remembers from one task to the next; one thing at a time.
_kept: dict[tuple, object] = {}


def kept(name: tuple, make: Callable[[], object]):
    """Something that tasks of one kind go on using in a worker process; tasks of another kind drop it."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Give back the memory of tasks that ran in this worker before."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task counts towards its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def discard(rows: DataFrame) -> None:
    """Delete the files of a frame that `materialize` wrote and nothing reads any more."""
    spark = rows.sparkSession
    files = rows.inputFiles()
    if files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame) -> DataFrame:
    """Columns k, doc_id, text, row: every input row under a unique key.

    k is doc_id where doc_ids are unique and not null. Otherwise the rows are sorted by
    (doc_id with nulls first, text), numbered in that order and written once, so that
    each of them, repeated ones too, counts as a document of its own. `row` is the whole
    input row; it costs nothing where it is not used.
    """
    wide = docs.select("doc_id", "text", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return wide.select(F.col("doc_id").cast("long").alias("k"), "doc_id", "text", "row")
    order = wide.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return materialize(order.select(F.monotonically_increasing_id().alias("k"), "doc_id", "text", "row"))


def input_rows(rows: DataFrame) -> DataFrame:
    """The original columns of rows that `keyed` made."""
    return rows.select("row.*")


def ints(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).astype(np.int32, copy=False))


def longs(values: np.ndarray) -> pa.Array:
    """64-bit values as Spark's signed long; hashes keep their bits."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def batch(schema: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(schema.values()), names=list(schema))
