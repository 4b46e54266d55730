"""Look-back windows: how far back a first scan reads and why it fell short."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.scalars import trim_blank

DAY_MS = 24 * 60 * 60 * 1000
MAX_SAFE_INTEGER = 2**53 - 1


def lookback_days(text: Column) -> Column:
    """Whole days from a text of digits, capped; anything else means the default."""
    digits = trim_blank(text)
    days = F.when(digits.rlike(r"^[0-9]+$"), digits.try_cast("bigint"))
    usable = days.between(1, MAX_SAFE_INTEGER)
    return F.when(usable, F.least(days, F.lit(fixed.LOOKBACK_MAX_DAYS))).otherwise(fixed.LOOKBACK_DAYS).cast("int")


def range_start(range_end: Column, days: Column) -> Column:
    """`days` times 24 hours before the end, independent of calendars."""
    safe = F.when(days > 0, F.least(days, F.lit(fixed.LOOKBACK_MAX_DAYS))).otherwise(fixed.LOOKBACK_DAYS)
    return F.timestamp_add("MILLISECOND", -safe.cast("bigint") * F.lit(DAY_MS), range_end)


def in_window(metadata: DataFrame, range_end: Column, days: Column) -> DataFrame:
    """Mails received inside the window; the bounds are constants and reach the scan."""
    return metadata.filter(
        (F.col("received_at") >= range_start(range_end, days)) & (F.col("received_at") <= range_end)
    )


def fallback_reason(attempts: DataFrame) -> DataFrame:
    """Add `reason`: why a default-length attempt fell back, NULL when it did not.

    Needs days_requested, sync_complete, quota, rate_limited, batch_blocked, elapsed_ms, budget_ms.
    """
    def signalled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    quota, rate, batch, window = fixed.LOOKBACK_FALLBACK_REASONS
    over_budget = (F.col("budget_ms") > 0) & (F.col("elapsed_ms") >= F.col("budget_ms"))
    in_scope = (F.col("days_requested") == fixed.LOOKBACK_DAYS) & ~signalled("sync_complete")
    reason = F.when(
        in_scope,
        F.when(signalled("quota"), quota)
        .when(signalled("rate_limited"), rate)
        .when(signalled("batch_blocked"), batch)
        .when(F.coalesce(over_budget, F.lit(False)), window),
    )
    return attempts.withColumn("reason", reason)


def fallback_log(reasons: DataFrame) -> DataFrame:
    """(user_id, line): one JSON log line per attempt that fell back.

    A reason outside the fixed list fails the query.
    """
    known = F.col("reason").isin(list(fixed.LOOKBACK_FALLBACK_REASONS))
    checked = F.when(known, F.col("reason")).otherwise(
        F.raise_error(F.concat(F.lit("Invalid look-back fallback reason: "), F.col("reason")))
    )
    line = F.to_json(
        F.struct(
            F.lit(fixed.LOOKBACK_FALLBACK_EVENT).alias("event"),
            F.col("user_id").alias("userId"),
            F.lit(fixed.LOOKBACK_FALLBACK_DAYS).alias("fellBackTo"),
            checked.alias("reason"),
        )
    )
    return reasons.filter(F.col("reason").isNotNull()).select("user_id", line.alias("line"))


def fallback_rate(reasons: DataFrame, guard: float = 0.1) -> DataFrame:
    """Share of default-length attempts that fell back, and whether it is within the guard."""
    rate = F.avg(F.col("reason").isNotNull().cast("double"))
    attempts = reasons.filter(F.col("days_requested") == fixed.LOOKBACK_DAYS)
    return attempts.agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count("reason").alias("fallbacks"),
        F.round(rate, 4).alias("rate"),
        (F.coalesce(rate, F.lit(0.0)) <= guard).alias("within_guard"),
    )
