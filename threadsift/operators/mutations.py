"""Table changes as pure functions: old snapshot + change rows -> new snapshot.

Keys are unique in a snapshot, so no join here can meet a hot key on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPSERT_RULES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    # table: (key columns, columns overwritten on conflict)
    "evaluations": (
        ("thread_id",),
        ("ai_evaluation_audit_id", "ai_insight", "ai_summary", "is_deal", "likely_scam", "ai_score"),
    ),
    "deals": (
        ("thread_id",),
        ("email_thread_evaluation_id", "deal_name", "deal_type", "category", "value", "currency", "brand"),
    ),
    "deal_contacts": (("deal_id", "user_id", "email"), ("contact_type",)),
    "contacts": (("user_id", "email"), ("name", "company_name", "title", "phone_number")),
    "batch_events": (("trigger_hash",), ("event_type", "created_at")),
}


def last_write(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key by `order`, combining on the map side first."""
    others = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    )
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    as_of: Column,
    how: str = "full",
) -> DataFrame:
    """Insert new keys, overwrite the listed columns of known keys.

    `source` must hold one row per key (see `last_write`). `created_at` and every
    column not listed keep their stored value; `updated_at` becomes `as_of`. With
    how="left" only known keys are changed and nothing is inserted.
    """
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = source.withColumn("_new", F.lit(True)).alias("new")
    matching = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    joined = old.join(new, matching, how)
    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str) -> Column:
        kind = target.schema[name].dataType
        stored = F.col(f"old.{name}")
        incoming = F.col(f"new.{name}").cast(kind) if name in source.columns else F.lit(None).cast(kind)
        if name in keys:
            return F.coalesce(stored, incoming)
        if name == "updated_at":
            return F.when(is_new, as_of).otherwise(stored)
        if name == "created_at" and name not in update_columns:
            return F.when(is_old, stored).otherwise(as_of)
        if name in update_columns:
            return F.when(is_new, as_of if name == "created_at" else incoming).otherwise(stored)
        return F.when(is_old, stored).otherwise(incoming)

    return joined.select(*[value(name).alias(name) for name in target.columns])


def upsert_table(name: str, target: DataFrame, source: DataFrame, as_of: Column) -> DataFrame:
    """Upsert with the key and overwrite rules of a named table."""
    keys, update_columns = UPSERT_RULES[name]
    present = [c for c in update_columns if c in target.columns]
    return upsert(target, source, keys, present, as_of)


def delete_matching(target: DataFrame, doomed: DataFrame, column: str, doomed_column: str | None = None) -> DataFrame:
    """Rows of `target` whose `column` is not among the doomed values."""
    ids = doomed.select(F.col(doomed_column or column).alias(column))
    return target.join(ids, column, "left_anti")


def append_missing(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Append rows whose key the target does not hold yet (first write wins)."""
    fresh = rows.join(target.select(key), key, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def apply_changes(states: DataFrame, changes: DataFrame, as_of: Column, keep_batch: bool = False) -> DataFrame:
    """Write changed status (and batch) values back to the state table.

    `changes`: email_metadata_id, status and, when the batch changes too,
    batch_id. One row per id. With `keep_batch` a change without a batch leaves the old one.
    """
    sets_batch = "batch_id" in changes.columns
    renamed = changes.select(
        "email_metadata_id",
        F.col("status").alias("_status"),
        *([F.col("batch_id").alias("_batch_id")] if sets_batch else []),
        F.lit(True).alias("_changed"),
    )
    joined = states.join(renamed, "email_metadata_id", "left")
    changed = F.col("_changed").isNotNull()
    columns = {
        "status": F.when(changed, F.col("_status")).otherwise(F.col("status")),
        "updated_at": F.when(changed, as_of).otherwise(F.col("updated_at")),
    }
    if sets_batch:
        batch = F.coalesce("_batch_id", "batch_id") if keep_batch else F.col("_batch_id")
        columns["batch_id"] = F.when(changed, batch).otherwise(F.col("batch_id"))
    return joined.withColumns(columns).select(*states.columns)
