"""Reading and writing the tables as versioned Parquet snapshots.

A snapshot is never overwritten: a change is written as the next version of its
table, and readers pick the newest complete one. A job that dies half-way leaves a
version without its success mark, which nobody reads.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from threadsift import schemas
from threadsift.sources.lookups import sorted_and_indexed

_VERSION = re.compile(r"^v=(\d+)$")


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Complete versions of a table, oldest first."""
    folder = f"{root}/{name}"
    found = [int(m.group(1)) for m in map(_VERSION.match, _children(spark, folder)) if m]
    return sorted(v for v in found if "_SUCCESS" in _children(spark, f"{folder}/v={v}"))


def schema_of(name: str) -> str:
    tables = {**schemas.DEAL_TABLES, **schemas.MAIL_TABLES}
    if name not in tables:
        raise KeyError(f"unknown table: {name}")
    return tables[name]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest snapshot of a table with its declared schema; empty before the first one."""
    known = versions(spark, root, name)
    if not known:
        return spark.createDataFrame([], schema_of(name))
    return spark.read.schema(schema_of(name)).parquet(f"{root}/{name}/v={known[-1]}")


def write_table(rows: DataFrame, root: str, name: str) -> int:
    """Write the next version of a table and return its number."""
    spark = rows.sparkSession
    taken = [int(m.group(1)) for m in map(_VERSION.match, _children(spark, f"{root}/{name}")) if m]
    version = max(taken, default=0) + 1
    conformed = schemas.conform(rows, schema_of(name))
    sorted_and_indexed(conformed, name).parquet(f"{root}/{name}/v={version}")
    return version


# The column each large table is updated or joined by.
BUCKET_KEYS = {
    "deal_states": "email_metadata_id",
    "email_metadata": "id",
    "email_senders": "email_metadata_id",
    "messages": "message_id",
    "deals": "thread_id",
    "email_thread_evaluations": "thread_id",
}


def write_bucketed(rows: DataFrame, root: str, name: str, buckets: int) -> DataFrame:
    """Write the next version of a large table bucketed by its key, and return it.

    A later update joins its changes to the buckets and moves only the changes. The
    bucketing is kept in the session's catalog, so clusters need a shared one.
    """
    spark = rows.sparkSession
    taken = [int(m.group(1)) for m in map(_VERSION.match, _children(spark, f"{root}/{name}")) if m]
    version = max(taken, default=0) + 1
    table = f"{name}_{uuid.uuid4().hex}"
    conformed = schemas.conform(rows, schema_of(name))
    (
        conformed.repartition(buckets, BUCKET_KEYS[name])
        .write.bucketBy(buckets, BUCKET_KEYS[name])
        .sortBy(BUCKET_KEYS[name])
        .option("path", f"{root}/{name}/v={version}")
        .saveAsTable(table)
    )
    return spark.table(table)


def register_views(spark: SparkSession, mail_root: str, deal_root: str) -> None:
    """All tables of both namespaces as temporary views for SQL users."""
    for root, names in ((mail_root, schemas.MAIL_TABLES), (deal_root, schemas.DEAL_TABLES)):
        for name in names:
            read_table(spark, root, name).createOrReplaceTempView(name)
