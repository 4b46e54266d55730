"""Which users finished their first look-back scan, and what was found.

Every table shrinks to one row per user (or per sync) by a map-side aggregation
before it is joined, so a user with a third of all mail is one row like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.operators.ranking import latest_per_key
from threadsift.session import materialize


def is_processed(status: str = "status") -> Column:
    """Not active any more; a NULL status counts as not processed."""
    return ~F.col(status).isin(list(fixed.ACTIVE_STATUSES))


def latest_sync(sync_states: DataFrame) -> DataFrame:
    """The newest sync of every user (ties: greatest id)."""
    rows = sync_states.select("user_id", F.col("id").alias("sync_state_id"), "created_at", "sync_strategy")
    return latest_per_key(rows, ["user_id"], [F.col("created_at"), F.col("sync_state_id")])


def sync_progress(latest: DataFrame, metadata: DataFrame, states: DataFrame) -> DataFrame:
    """Total and processed message counts for users whose latest sync is a look-back."""
    totals = metadata.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_messages"))
    processed = states.groupBy("user_id").agg(F.count_if(is_processed()).alias("processed_messages"))
    return (
        latest.filter(F.col("sync_strategy") == fixed.LOOKBACK)
        .join(totals, "user_id", "left")
        .join(processed, "user_id", "left")
        .select(
            "user_id",
            "sync_state_id",
            F.col("created_at").alias("initiated_at"),
            F.coalesce("total_messages", F.lit(0)).alias("total_messages"),
            F.coalesce("processed_messages", F.lit(0)).alias("processed_messages"),
        )
    )


def successful_lookbacks(sync_states: DataFrame, sync_events: DataFrame) -> DataFrame:
    """Look-back syncs whose latest success event has no later failure event."""
    success = F.col("event").isin(list(fixed.SYNC_SUCCESS_EVENTS))
    failure = F.col("event").isin(list(fixed.SYNC_FAILURE_EVENTS))
    ends = (
        sync_events.filter(success | failure)
        .groupBy("sync_state_id")
        .agg(
            F.max(F.when(success, F.col("created_at"))).alias("succeeded_at"),
            F.max(F.when(failure, F.col("created_at"))).alias("failed_at"),
        )
        .filter(
            F.col("succeeded_at").isNotNull()
            & (F.col("failed_at").isNull() | (F.col("failed_at") <= F.col("succeeded_at")))
        )
        .select(F.col("sync_state_id").alias("id"))
    )
    lookbacks = sync_states.filter(F.col("sync_strategy") == fixed.LOOKBACK)
    return lookbacks.join(ends, "id", "left_semi").select("id", "user_id", "created_at")


def without_earlier_success(candidates: DataFrame, successes: DataFrame) -> DataFrame:
    """Candidates with no successful look-back strictly before their own start."""
    first = successes.groupBy("user_id").agg(F.min("created_at").alias("first_success_at"))
    return (
        candidates.join(first, "user_id", "left")
        .filter(F.col("first_success_at").isNull() | (F.col("first_success_at") >= F.col("initiated_at")))
        .drop("first_success_at")
    )


def eligible_users(
    sync_states: DataFrame, sync_events: DataFrame, metadata: DataFrame, states: DataFrame
) -> DataFrame:
    progress = sync_progress(latest_sync(sync_states), metadata, states)
    finished = progress.filter(
        F.col("initiated_at").isNotNull()
        & (F.col("total_messages") > 0)
        & (F.col("processed_messages") >= F.col("total_messages"))
    )
    return without_earlier_success(finished, successful_lookbacks(sync_states, sync_events))


def category_counts() -> list[Column]:
    """Deals of each category, as aggregates."""
    return [F.count_if(F.col("category") == category).alias(f"db_{category}") for category in fixed.CATEGORIES]


def contacts_per_user(deal_contacts: DataFrame) -> DataFrame:
    return deal_contacts.groupBy("user_id").agg(F.count_distinct("email").alias("contacts"))


def deal_counts(users: DataFrame, deals: DataFrame) -> DataFrame:
    """Deals per category touched since each user's sync began; users without deals count 0."""
    starts = users.select("user_id", "initiated_at")
    found = (
        deals.select("user_id", "category", "updated_at")
        .join(starts, "user_id")
        .filter(F.col("updated_at") >= F.col("initiated_at"))
        .groupBy("user_id")
        .agg(*category_counts())
    )
    names = [f"db_{category}" for category in fixed.CATEGORIES]
    return users.select("user_id").join(found, "user_id", "left").na.fill(0, names)


def contact_counts(users: DataFrame, deal_contacts: DataFrame, deals: DataFrame, contacts: DataFrame) -> DataFrame:
    """Distinct stored contacts per user on deals touched since the sync began."""
    starts = users.select("user_id", "initiated_at")
    recent = (
        deals.select(F.col("id").alias("deal_id"), "user_id", "updated_at")
        .join(starts, "user_id")
        .filter(F.col("updated_at") >= F.col("initiated_at"))
        .select("deal_id", "user_id")
    )
    known = contacts.select("user_id", "email").distinct()
    return (
        deal_contacts.select("deal_id", "user_id", "email")
        .join(recent, ["deal_id", "user_id"])
        .select("user_id", "email")
        .distinct()
        .join(known, ["user_id", "email"])
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("contacts_added"))
    )


def eligible_report(
    sync_states: DataFrame,
    sync_events: DataFrame,
    metadata: DataFrame,
    states: DataFrame,
    deals: DataFrame,
    deal_contacts: DataFrame,
    contacts: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Eligible users with their deal and contact counts, earliest start first."""
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit <= 0):
        raise ValueError(f"limit must be a positive integer: {limit}")
    users = eligible_users(sync_states, sync_events, metadata, states)
    if limit is not None:
        users = users.orderBy("initiated_at", "user_id").limit(limit)
    # Three joins start from the eligible users; one row per user is cheap to keep.
    users = materialize(users.select("user_id", "initiated_at"))
    names = [f"db_{category}" for category in fixed.CATEGORIES]
    return (
        users.select("user_id", "initiated_at")
        .join(deal_counts(users, deals), "user_id", "left")
        .join(contact_counts(users, deal_contacts, deals, contacts), "user_id", "left")
        .select(
            "user_id",
            "initiated_at",
            *[F.coalesce(name, F.lit(0)).alias(name) for name in names],
            F.coalesce("contacts_added", F.lit(0)).alias("contacts_added"),
        )
        .orderBy("initiated_at", "user_id")
    )


def sync_status(
    sync_states: DataFrame,
    metadata: DataFrame,
    states: DataFrame,
    deals: DataFrame,
    deal_contacts: DataFrame,
    contacts: DataFrame,
) -> DataFrame:
    """Scan status of every user with a sync: message counts, completion time, findings."""
    users = latest_sync(sync_states).select(
        "user_id", F.col("sync_state_id").alias("sync_id"), F.col("created_at").alias("initiated_at")
    )
    totals = metadata.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_messages"))
    progress = states.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("prepped_messages"),
        F.count_if(is_processed()).alias("processed_messages"),
        F.max(F.when(is_processed(), F.col("updated_at"))).alias("completed_at"),
    )
    contacts_found = contact_counts(users, deal_contacts, deals, contacts)
    counts = ["total_messages", "prepped_messages", "processed_messages"]
    names = [f"db_{category}" for category in fixed.CATEGORIES]
    return (
        users.join(totals, "user_id", "left")
        .join(progress, "user_id", "left")
        .join(deal_counts(users, deals), "user_id", "left")
        .join(contacts_found, "user_id", "left")
        .withColumnRenamed("contacts_added", "identified_contacts_count")
        .na.fill(0, [*counts, *names, "identified_contacts_count"])
    )
