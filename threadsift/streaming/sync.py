"""Incremental sync of arriving mail metadata into the state table.

The ids that have a state are the keys of the stream's own state store. Files of the state
table are a source of the stream like the arriving metadata: each is read once, in the
first micro-batch or when it appears, and never again. A mail is new if its key was first
seen in the current micro-batch and no state file held it. So a micro-batch costs what
arrives, however large the state table is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadsift import schemas
from threadsift.operators.states import new_states

# Keys are kept on the executors' disks, with changes written to the checkpoint.
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _sink_name(spark: SparkSession, checkpoint_path: str) -> str:
    """A name that belongs to a checkpoint and goes with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_path}/sink-name")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        # Renamed when complete: a driver that dies here leaves no half name.
        part = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_path}/sink-name-{uuid.uuid4().hex}")
        out = system.create(part)
        out.writeUTF(uuid.uuid4().hex)
        out.close()
        system.rename(part, path)
    stored = system.open(path)
    try:
        return stored.readUTF()
    finally:
        stored.close()


def first_seen(arriving: DataFrame, known: DataFrame) -> DataFrame:
    """(id, user_id, thread_id, message_id, first_seen) of mails that the current micro-batch brings first.

    `known`: streaming, the ids that have a state. The clock is that of the micro-batch, the
    same when it is repeated.
    """
    clock = F.current_timestamp()
    mail = F.struct("thread_id", "user_id", "message_id")
    old = known.select("id", F.lit(True).alias("is_known"), F.lit(None).cast("struct<thread_id: string, user_id: string, message_id: string>").alias("mail"))
    new = arriving.select("id", F.lit(False).alias("is_known"), mail.alias("mail"))
    keys = (
        old.unionByName(new)
        .withColumn("seen_at", clock)
        .groupBy("id")
        .agg(F.max("is_known").alias("is_known"), F.min("seen_at").alias("first_seen"), F.min("mail").alias("mail"))
    )
    # Updated keys come out again; only those whose first time is now are new.
    return keys.filter(~F.col("is_known") & (F.col("first_seen") == clock)).select("id", "mail.*", "first_seen")


def start_sync(
    arriving: DataFrame,
    states_path: str,
    checkpoint_path: str,
    as_of: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Add a pending state for every new mail, by default until nothing is left.

    `arriving` is a streaming DataFrame in metadata shape. The states carry `as_of`, or the
    clock of their micro-batch. Every micro-batch writes a folder of its own under the name of
    its checkpoint, so one that is repeated after a lost executor or driver replaces what
    it wrote. With another `trigger` the query goes on.
    """
    spark = arriving.sparkSession
    sink = _sink_name(spark, checkpoint_path)
    known = spark.readStream.schema(schemas.STATES).parquet(f"{states_path}/*").select(F.col("email_metadata_id").alias("id"))

    def add(batch: DataFrame, number: int) -> None:
        rows = new_states(batch, F.col("first_seen") if as_of is None else as_of)
        schemas.conform(rows, schemas.STATES).write.mode("overwrite").parquet(f"{states_path}/added-{sink}-{number:09d}")

    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return (
            first_seen(arriving, known)
            .writeStream.foreachBatch(add)
            .outputMode("update")
            .option("checkpointLocation", checkpoint_path)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def prepare_states(states: DataFrame, path: str) -> None:
    """Write the state table the stream adds to, in its declared column types."""
    schemas.conform(states, schemas.STATES).write.mode("errorifexists").parquet(f"{path}/base")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATES).parquet(f"{path}/*")
