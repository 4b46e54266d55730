"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Run-time SQL settings every job relies on. A setting the cluster has already
# chosen explicitly wins, except the time zone: all clocks here are UTC.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot user or thread is split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Short lists of ids reach the Bloom filters of Parquet files one by one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    # JSON replies may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Remembers the fallback of a local session; the cluster's own setting cannot be changed later.
_OWN_FOLDER = "threadsift.shared.folder"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    chosen = {entry[0] for entry in spark.sparkContext.getConf().getAll()}
    for key, value in SQL_DEFAULTS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threadsift")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # The rule expressions are large; recording a call site per column slows planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    On a cluster `spark.checkpoint.dir` names it. Only a local session without
    that setting falls back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_FOLDER, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="threadsift-")
    spark.conf.set(_OWN_FOLDER, folder)
    return folder


def materialize_counting(rows: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """`materialize`, and aggregates of the rows taken while they are written; 0 where there are no rows."""
    seen = Observation(f"counts-{uuid.uuid4().hex}")
    written = materialize(rows.observe(seen, *[value.alias(name) for name, value in counts.items()]))
    found = seen.get
    return written, {name: found.get(name) or 0 for name in counts}


def materialize(rows: DataFrame, **options: str) -> DataFrame:
    """Write a frame once to the shared folder, with options of its writer, and read it back.

    Used where several results follow from one costly frame. The files survive a lost
    executor, and readers prune columns and see real sizes.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
