"""The message state machine over the whole state table.

Every function maps snapshots to snapshots (or to the change rows for
`mutations.apply_changes`). `as_of` is the clock; limits are optional.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.scalars import minutes_before, stable_id
from threadsift.operators.mutations import apply_changes
from threadsift.operators.ranking import first_n_per_key, in_chunks
from threadsift.session import materialize

BATCH_COLUMNS = ("email_metadata_id", "message_id", "user_id", "thread_id", "sync_state_id")


# ---- reading the rows of batches ---------------------------------------------
def batch_rows(states: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Rows of one batch, or of every batch with its id when none is named."""
    if batch_id is None:
        return states.filter(F.col("batch_id").isNotNull()).select("batch_id", *BATCH_COLUMNS)
    return states.filter(F.col("batch_id") == batch_id).select(*BATCH_COLUMNS)


def batch_id_pairs(states: DataFrame) -> DataFrame:
    return states.filter(F.col("batch_id").isNotNull()).select("batch_id", "email_metadata_id", "thread_id")


def batch_thread_users(states: DataFrame) -> DataFrame:
    return states.filter(F.col("batch_id").isNotNull()).select("batch_id", "thread_id", "user_id").distinct()


def with_previous_evaluation(rows: DataFrame, evaluations: DataFrame, user_settings: DataFrame) -> DataFrame:
    """Batch rows with the previous evaluation of their thread and the creator's address."""
    previous = evaluations.select(
        "thread_id",
        F.col("ai_summary").alias("previous_ai_summary"),
        F.col("is_deal").alias("previous_is_deal"),
    )
    creators = user_settings.select("user_id", F.col("email").alias("creator_email"))
    return rows.join(previous, "thread_id", "left").join(creators, "user_id", "left")


def count_by_batch_and_status(states: DataFrame) -> DataFrame:
    return states.filter(F.col("batch_id").isNotNull()).groupBy("batch_id", "status").count()


# ---- sync ----------------------------------------------------------------------
def missing_states(states: DataFrame, metadata: DataFrame, as_of: Column) -> DataFrame:
    """New pending rows for metadata without a state row; the sync id stays NULL."""
    known = states.select(F.col("email_metadata_id").alias("id"))
    return new_states(metadata.join(known, "id", "left_anti"), as_of)


def new_states(metadata: DataFrame, as_of: Column) -> DataFrame:
    """A pending row for each row of metadata."""
    return metadata.select(
        stable_id(F.lit("state"), F.col("id")).alias("id"),
        F.col("id").alias("email_metadata_id"),
        "user_id",
        "thread_id",
        "message_id",
        F.lit(None).cast("string").alias("sync_state_id"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("batch_id"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    )


def sync(states: DataFrame, metadata: DataFrame, as_of: Column) -> DataFrame:
    return states.unionByName(missing_states(states, metadata, as_of))


# ---- claims --------------------------------------------------------------------
def oldest_rows(states: DataFrame, status: str, limit: int) -> DataFrame:
    """The rows of a status that have waited longest; ties go by id."""
    return states.filter(F.col("status") == status).orderBy("updated_at", "email_metadata_id").limit(limit)


def claim_for_filter(states: DataFrame, batch_id: str, as_of: Column, limit: int | None = None) -> DataFrame:
    """Pending rows, oldest first up to `limit`, become 'filtering' under a batch id."""
    pending = F.col("status") == "pending"
    if limit is None:
        return _stamp(states, pending, as_of, status=F.lit("filtering"), batch_id=F.lit(batch_id))
    changes = oldest_rows(states, "pending", limit).select(
        "email_metadata_id", F.lit("filtering").alias("status"), F.lit(batch_id).alias("batch_id")
    )
    return apply_changes(states, changes, as_of)


def complete_threads(states: DataFrame) -> DataFrame:
    """Threads with a row ready for classification and no sibling still being filtered.

    Siblings count within the same sync only; a NULL sync id matches nothing. Each
    thread shrinks to one row per sync before it is compared, so a huge thread
    costs no more than a small one.
    """
    ready = F.col("status") == "pending_classification"
    early = F.col("status").isin("pending", "filtering") & F.col("sync_state_id").isNotNull()
    per_sync = (
        states.filter(ready | early)
        .groupBy("thread_id", "sync_state_id")
        .agg(F.bool_or(ready).alias("ready"), F.bool_or(early).alias("early"))
    )
    return per_sync.filter(F.col("ready") & ~F.col("early")).select("thread_id").distinct()


def claim_for_classification(
    states: DataFrame, batch_id: str, as_of: Column, limit: int | None = None
) -> DataFrame:
    """All ready rows of complete threads become 'classifying' under a batch id."""
    threads = complete_threads(states)
    if limit is not None:
        threads = threads.orderBy("thread_id").limit(limit)
    changes = (
        states.filter(F.col("status") == "pending_classification")
        .join(threads, "thread_id", "left_semi")
        .select("email_metadata_id", F.lit("classifying").alias("status"), F.lit(batch_id).alias("batch_id"))
    )
    return apply_changes(states, changes, as_of)


# ---- sub-batches ---------------------------------------------------------------
def row_sub_batches(rows: DataFrame, size: int) -> DataFrame:
    """(email_metadata_id, sub_batch_id): each parent batch cut into groups of `size` rows."""
    chunks = in_chunks(rows.select("batch_id", "email_metadata_id"), ["batch_id"], "email_metadata_id", size)
    return chunks.select("email_metadata_id", _sub_batch_id().alias("sub_batch_id"))


def thread_sub_batches(rows: DataFrame, size: int) -> DataFrame:
    """(batch_id, thread_id, sub_batch_id): groups of `size` threads; a thread never splits."""
    threads = rows.select("batch_id", "thread_id").distinct()
    chunks = in_chunks(threads, ["batch_id"], "thread_id", size)
    return chunks.select("batch_id", "thread_id", _sub_batch_id().alias("sub_batch_id"))


def _sub_batch_id() -> Column:
    return stable_id(F.lit("sub"), F.col("batch_id"), F.col("chunk_no"))


def assign_sub_batches(
    states: DataFrame, assignment: DataFrame, on: Sequence[str], parents: Column, as_of: Column
) -> DataFrame:
    """Move the rows of parent batches to their sub-batches.

    Rows of a parent that the assignment does not name lose their batch id.
    """
    joined = states.join(assignment, list(on), "left")
    return joined.withColumns(
        {
            "updated_at": F.when(parents, as_of).otherwise(F.col("updated_at")),
            "batch_id": F.when(parents, F.col("sub_batch_id")).otherwise(F.col("batch_id")),
        }
    ).select(*states.columns)


# ---- plain updates -------------------------------------------------------------
def _stamp(states: DataFrame, where: Column, as_of: Column, **values: Column) -> DataFrame:
    hit = F.coalesce(where, F.lit(False))
    columns = {name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()}
    columns["updated_at"] = F.when(hit, as_of).otherwise(F.col("updated_at"))
    return states.withColumns(columns)


def _asked(states: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which a condition holds, and all others."""
    return states.filter(where), states.filter(~F.coalesce(where, F.lit(False)))


def set_status_by_ids(states: DataFrame, ids: DataFrame, status: str, as_of: Column) -> DataFrame:
    return apply_changes(states, ids.select("email_metadata_id", F.lit(status).alias("status")), as_of)


def set_status_by_batches(
    states: DataFrame, batches: DataFrame, from_status: str, to_status: str, as_of: Column
) -> DataFrame:
    """Rows of the given batches that are in `from_status` move to `to_status`.

    Only rows that can match are joined: the rows without a batch would all meet under
    one key.
    """
    asked, others = _asked(states, F.col("batch_id").isNotNull() & (F.col("status") == from_status))
    marked = batches.select("batch_id").distinct().withColumn("_hit", F.lit(True))
    joined = asked.join(marked, "batch_id", "left")
    moved = _stamp(joined, F.col("_hit").isNotNull(), as_of, status=F.lit(to_status))
    return moved.select(*states.columns).unionByName(others)


def count_in_batches(states: DataFrame, batches: DataFrame, status: str) -> DataFrame:
    """One row, n: how many rows in `status` the given batches hold."""
    asked, _ = _asked(states, F.col("batch_id").isNotNull() & (F.col("status") == status))
    return asked.join(batches.select("batch_id"), "batch_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


def refresh_batches(states: DataFrame, batches: DataFrame, as_of: Column) -> DataFrame:
    """Renew the timestamp of every row of the given batches."""
    asked, others = _asked(states, F.col("batch_id").isNotNull())
    marked = batches.select("batch_id").distinct().withColumn("_hit", F.lit(True))
    joined = asked.join(marked, "batch_id", "left")
    return _stamp(joined, F.col("_hit").isNotNull(), as_of).select(*states.columns).unionByName(others)


# ---- stuck and dead batches ----------------------------------------------------
def stale_batch_attempts(
    states: DataFrame, batch_events: DataFrame, status: str, as_of: Column, minutes: int = fixed.STUCK_MINUTES
) -> DataFrame:
    """Attempts per batch with a stale row in `status`: its distinct trigger hashes.

    Both sides shrink to one row per batch before they meet.
    """
    stale = states.filter(
        (F.col("status") == status)
        & F.col("batch_id").isNotNull()
        & (F.col("updated_at") < minutes_before(as_of, minutes))
    )
    attempts = batch_events.groupBy("batch_id").agg(F.count_distinct("trigger_hash").alias("attempts"))
    return (
        stale.select("batch_id")
        .distinct()
        .join(attempts, "batch_id", "left")
        .select("batch_id", F.coalesce("attempts", F.lit(0)).alias("attempts"))
    )


def active_batches(
    states: DataFrame, batch_events: DataFrame, statuses: Sequence[str], as_of: Column, minutes: int = fixed.STUCK_MINUTES
) -> DataFrame:
    """(batch_id, status, n, attempts) of the batches with a stale row in an active status; n counts all rows in it.

    One pass over the states, whatever the number of statuses.
    """
    stale = F.col("updated_at") < minutes_before(as_of, minutes)
    held = (
        states.filter(F.col("status").isin(list(statuses)) & F.col("batch_id").isNotNull())
        .groupBy("batch_id", "status")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(stale).alias("is_stale"))
        .filter("is_stale")
    )
    attempts = batch_events.groupBy("batch_id").agg(F.count_distinct("trigger_hash").alias("attempts"))
    return held.join(attempts, "batch_id", "left").select("batch_id", "status", "n", F.coalesce("attempts", F.lit(0)).alias("attempts"))


def stuck_batches(states, batch_events, status, as_of, minutes=fixed.STUCK_MINUTES, max_attempts=fixed.MAX_ATTEMPTS):
    attempts = stale_batch_attempts(states, batch_events, status, as_of, minutes)
    return attempts.filter(F.col("attempts") < max_attempts)


def dead_batches(states, batch_events, status, as_of, minutes=fixed.STUCK_MINUTES, max_attempts=fixed.MAX_ATTEMPTS):
    attempts = stale_batch_attempts(states, batch_events, status, as_of, minutes)
    return attempts.filter(F.col("attempts") >= max_attempts)


def event_rows(batches: DataFrame, batch_type: str, event_type: str, as_of: Column) -> DataFrame:
    """Event rows for batches. 'new' and 'complete' share the batch id as their key,
    so completion replaces creation; the other kinds get a key of their own."""
    batch = F.col("batch_id")
    own_key = stable_id(F.lit(event_type), batch, F.date_format(as_of, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return batches.select(
        (batch if event_type in ("new", "complete") else own_key).alias("trigger_hash"),
        "batch_id",
        F.lit(batch_type).alias("batch_type"),
        F.lit(event_type).alias("event_type"),
        as_of.alias("created_at"),
    )


def retry_stuck(
    states: DataFrame,
    batch_events: DataFrame,
    status: str,
    batch_type: str,
    as_of: Column,
    split_size: int,
    minutes: int = fixed.STUCK_MINUTES,
    max_attempts: int = fixed.MAX_ATTEMPTS,
) -> tuple[DataFrame, DataFrame]:
    """(states, new event rows): stuck batches renewed with a 'retrigger' event.

    A stuck parent batch is cut into sub-batches instead, each with a 'new' event:
    by rows for filtering, by threads for classification.
    """
    # The list of stuck batches is short next to the tables it comes from, and four
    # steps below start from it.
    stuck = materialize(
        stuck_batches(states, batch_events, status, as_of, minutes, max_attempts).select("batch_id")
    )
    is_parent = F.col("batch_id").startswith(fixed.MEGA_BATCH_PREFIX)
    batched, others = _asked(states, F.col("batch_id").isNotNull())
    marked = batched.join(stuck.withColumn("_stuck", F.lit(True)), "batch_id", "left")

    parent_rows = states.filter(is_parent).join(stuck, "batch_id", "left_semi")
    if batch_type == "filter":
        pieces, on = row_sub_batches(parent_rows, split_size), ["email_metadata_id"]
    else:
        pieces, on = thread_sub_batches(parent_rows, split_size), ["batch_id", "thread_id"]
    hit = F.col("_stuck").isNotNull()
    updated = marked.join(pieces, on, "left").withColumns(
        {
            "updated_at": F.when(hit, as_of).otherwise(F.col("updated_at")),
            "batch_id": F.when(hit & is_parent, F.col("sub_batch_id")).otherwise(F.col("batch_id")),
        }
    )
    new_batches = pieces.select(F.col("sub_batch_id").alias("batch_id")).distinct()
    events = event_rows(stuck.filter(~is_parent), batch_type, "retrigger", as_of).unionByName(
        event_rows(new_batches, batch_type, "new", as_of)
    )
    return updated.select(*states.columns).unionByName(others), events


def renewed_batches(batch_events: DataFrame, batch_type: str, as_of: Column) -> DataFrame:
    """Ids of the batches that a retry at `as_of` renewed or split off a parent."""
    at = (F.col("batch_type") == batch_type) & F.col("event_type").isin("retrigger", "new") & (F.col("created_at") == as_of)
    return batch_events.filter(at).select("batch_id").distinct()


def dead_letter(
    states: DataFrame,
    batch_events: DataFrame,
    status: str,
    batch_type: str,
    as_of: Column,
    minutes: int = fixed.STUCK_MINUTES,
    max_attempts: int = fixed.MAX_ATTEMPTS,
) -> tuple[DataFrame, DataFrame]:
    """(states, event rows): rows in `status` of exhausted batches fail."""
    dead = dead_batches(states, batch_events, status, as_of, minutes, max_attempts).select("batch_id")
    return (
        set_status_by_batches(states, dead, status, "failed", as_of),
        event_rows(dead, batch_type, "dead_letter", as_of),
    )


# ---- orphans -------------------------------------------------------------------
def _orphaned(statuses: Sequence[str], stale_minutes: int | str, as_of: Column) -> Column:
    text = str(stale_minutes).strip()
    if isinstance(stale_minutes, bool) or not text.isdigit():
        raise TypeError(f"stale_minutes must be a non-negative integer, got: {stale_minutes}")
    return (
        F.col("status").isin(list(statuses))
        & F.col("batch_id").isNull()
        & (F.col("updated_at") < minutes_before(as_of, int(text)))
    )


def count_orphans(states: DataFrame, statuses: Sequence[str], stale_minutes: int | str, as_of: Column) -> DataFrame:
    return states.filter(_orphaned(statuses, stale_minutes, as_of)).agg(F.count(F.lit(1)).alias("c"))


def fail_orphans(states: DataFrame, statuses: Sequence[str], stale_minutes: int | str, as_of: Column) -> DataFrame:
    """Stale rows in the given statuses that never got a batch fail."""
    return _stamp(states, _orphaned(statuses, stale_minutes, as_of), as_of, status=F.lit("failed"))


# ---- recovery ------------------------------------------------------------------
def users_with_failures(states: DataFrame, limit: int | None = None) -> DataFrame:
    """Users with failed rows and the oldest of them, oldest first."""
    users = (
        states.filter(F.col("status") == "failed")
        .groupBy("user_id")
        .agg(F.min("updated_at").alias("oldest"))
    )
    return users if limit is None else users.orderBy("oldest", "user_id").limit(limit)


def failed_rows(
    states: DataFrame,
    user_limit: int | None = None,
    rows_per_user: int | None = None,
) -> DataFrame:
    """Failed rows to recover; with limits, the oldest rows of the users who wait longest."""
    failed = states.filter(F.col("status") == "failed")
    if user_limit is not None:
        failed = failed.join(users_with_failures(states, user_limit).select("user_id"), "user_id", "left_semi")
    if rows_per_user is not None:
        order = [F.col("updated_at"), F.col("email_metadata_id")]
        failed = first_n_per_key(failed, ["user_id"], order, rows_per_user, "email_metadata_id")
    return failed.select("id", *BATCH_COLUMNS)


def split_by_availability(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """Rows with `is_available`: whether their message can still be read."""
    present = messages.select("message_id", F.lit(True).alias("_present"))
    return rows.join(present, "message_id", "left").withColumn("is_available", F.col("_present").isNotNull()).drop(
        "_present"
    )


def recover(
    states: DataFrame,
    messages: DataFrame,
    as_of: Column,
    user_limit: int | None = None,
    rows_per_user: int | None = None,
) -> DataFrame:
    """Failed rows go back to pending (no batch) or, without a message, to dead (batch kept)."""
    return apply_recovery(states, split_by_availability(failed_rows(states, user_limit, rows_per_user), messages), as_of)


def apply_recovery(states: DataFrame, rows: DataFrame, as_of: Column) -> DataFrame:
    """`recover` for rows of `split_by_availability`."""
    changes = rows.select("email_metadata_id", "is_available")
    joined = states.join(changes, "email_metadata_id", "left")
    recovered, hit = F.col("is_available"), F.col("is_available").isNotNull()
    return joined.withColumns(
        {
            "status": F.when(recovered, "pending").when(hit, "dead").otherwise(F.col("status")),
            "batch_id": F.when(recovered, F.lit(None)).otherwise(F.col("batch_id")),
            "updated_at": F.when(hit, as_of).otherwise(F.col("updated_at")),
        }
    ).select(*states.columns)


# ---- reports -------------------------------------------------------------------
def transition_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many rows went from one status to another; new rows come from '(none)'."""
    old = before.select("email_metadata_id", F.col("status").alias("old_status"))
    new = after.select("email_metadata_id", F.col("status").alias("new_status"))
    return (
        new.join(old, "email_metadata_id", "left")
        .select(F.coalesce("old_status", F.lit("(none)")).alias("old_status"), "new_status")
        .groupBy("old_status", "new_status")
        .agg(F.count(F.lit(1)).alias("n"))
    )
