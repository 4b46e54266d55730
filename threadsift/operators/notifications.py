"""Scan-complete notifications: markers, payloads, outbox and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.scalars import number_or_zero, trim_blank

# ---- Fixed values: payload field per count column ------------------------------
PAYLOAD_COUNTS = {
    "new": "db_new",
    "inProgress": "db_in_progress",
    "completed": "db_completed",
    "likelyScam": "db_likely_scam",
    "lowConfidence": "db_low_confidence",
    "notInterested": "db_not_interested",
}


def is_sent(integer_value: Column, double_value: Column) -> Column:
    """Whether a marker says 'already notified'.

    A non-empty integer text decides alone: it must be all digits and above 0. Else
    a finite double above 0 counts.
    """
    text = trim_blank(integer_value)
    from_text = text.rlike(r"^-?\d+$") & (text.try_cast("double") > 0)
    from_number = ~F.isnan(double_value) & (double_value > 0) & (double_value < F.lit(float("inf")))
    has_text = F.coalesce(integer_value, F.lit("")) != ""
    return F.coalesce(F.when(has_text, from_text).otherwise(from_number), F.lit(False))


def notified_users(markers: DataFrame) -> DataFrame:
    return markers.filter(is_sent(F.col("integer_value"), F.col("double_value"))).select("user_id").distinct()


def _count(value: Column) -> Column:
    """A count without a trailing '.0' when it is whole."""
    number = number_or_zero(value)
    return F.when((number == F.floor(number)) & (F.abs(number) < 1e15), number.cast("bigint")).otherwise(F.lit(None))


def payload(user_id: Column) -> Column:
    counts = [_count(F.col(column)).alias(name) for name, column in PAYLOAD_COUNTS.items()]
    return F.to_json(
        F.struct(
            user_id.cast("string").alias("userId"),
            F.lit(fixed.SCAN_COMPLETE_EVENT).alias("eventType"),
            F.struct(
                F.struct(*counts).alias("dealCounts"), _count(F.col("contacts_added")).alias("contactsAdded")
            ).alias("eventData"),
        )
    )


def lower_case_columns(rows: DataFrame) -> DataFrame:
    """Column names may come in upper or lower case."""
    return rows.toDF(*[name.lower() for name in rows.columns])


def has_user(rows: DataFrame) -> Column:
    return F.coalesce(trim_blank(F.col("user_id").cast("string")) != "", F.lit(False))


def classify(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """Eligible rows with `outcome`: 'error' (no user id), 'skipped' (notified) or 'to_send'."""
    known = lower_case_columns(rows)
    sent = notified_users(markers).withColumn("_sent", F.lit(True))
    outcome = F.when(~has_user(known), "error").when(F.col("_sent"), "skipped").otherwise("to_send")
    return known.join(sent, "user_id", "left").withColumn("outcome", outcome).drop("_sent")


def outbox(rows: DataFrame, markers: DataFrame) -> DataFrame:
    """(user_id, payload): one JSON body per user still to be notified."""
    waiting = classify(rows, markers).filter(F.col("outcome") == "to_send")
    return waiting.select("user_id", payload(F.col("user_id")).alias("payload"))


def quarantined(rows: DataFrame) -> DataFrame:
    known = lower_case_columns(rows)
    return known.filter(~has_user(known))


def summary(rows: DataFrame, markers: DataFrame) -> DataFrame:
    return classify(rows, markers).agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "to_send").alias("to_send"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
    )
