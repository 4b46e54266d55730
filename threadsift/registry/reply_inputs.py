"""Raw reply texts built by Spark from `f_replies`, five items per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _item() -> Column:
    contact = F.struct(F.col("contact_name").alias("name"), F.col("contact_email").alias("email"), F.lit("Brand").alias("company"))
    return F.struct(
        "thread_index",
        "is_deal",
        (F.col("lang") == "en").alias("is_english"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("language"),
        "ai_score",
        "category",
        F.lit("insight").alias("ai_insight"),
        "ai_summary",
        contact.alias("main_contact"),
        F.concat(F.lit("Deal “"), F.col("thread_id"), F.lit("”")).alias("deal_name"),
        F.lit("Brand").alias("deal_brand"),
        "deal_type",
        "deal_value",
        F.lit("EUR").alias("deal_currency"),
    )


def raw_batches(replies: DataFrame) -> DataFrame:
    """(batch_id, shape, json, raw): a batch holds five items, so each list is small."""
    batches = replies.groupBy("batch_id", "shape").agg(
        F.to_json(F.array_sort(F.collect_list(_item()))).alias("json")
    )
    return batches.withColumn("raw", shaped(F.col("json"), F.col("shape")))


def shaped(json: Column, shape: Column) -> Column:
    return (
        F.when(shape == "fenced", F.concat(F.lit("```json\n"), json, F.lit("\n```")))
        .when(shape == "wrapped", F.concat(F.lit('{"results": '), json, F.lit("}")))
        .when(shape == "prose", F.concat(F.lit("Here you go:\n"), json, F.lit("\nHope it helps.")))
        .otherwise(F.substring(json, F.lit(1), F.length(json) - 2))
    )


def batch_order(replies: DataFrame) -> DataFrame:
    return replies.select("batch_id", "thread_index", "thread_id")


def layered(replies: DataFrame) -> DataFrame:
    """Every batch has a primary reply; a broken one may have a correction or a fallback,
    and some batches are cached already."""
    raw = raw_batches(replies)
    number = F.col("batch_id") % 16
    broken = F.col("shape") == "broken"
    parts = [
        raw.select("batch_id", F.lit("primary").alias("layer"), F.lit("big-model").alias("model"), "raw"),
        raw.filter(broken).select(
            "batch_id",
            F.lit("corrective").alias("layer"),
            F.lit("big-model").alias("model"),
            F.when(number == 3, shaped(F.col("json"), F.lit("fenced"))).otherwise(F.lit("sorry")).alias("raw"),
        ),
        raw.filter(broken).select(
            "batch_id",
            F.lit("fallback").alias("layer"),
            F.lit("small-model").alias("model"),
            F.when(number < 12, shaped(F.col("json"), F.lit("prose"))).otherwise(F.lit("no")).alias("raw"),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def audits(replies: DataFrame) -> DataFrame:
    """A cached evaluation per batch: keyed, plain list, or broken, by shape."""
    raw = raw_batches(replies)
    text = (
        F.when(F.col("shape") == "wrapped", F.concat(F.lit('{"threads": '), F.col("json"), F.lit("}")))
        .when(F.col("shape") == "broken", F.lit("{not json"))
        .otherwise(F.col("json"))
    )
    return raw.select("batch_id", text.alias("ai_evaluation"))
