"""From raw model replies to clean items.

A reply is one row of text; repairing, parsing and coercing it are column
expressions over VARIANT, and a bad reply becomes an error text, not a failed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions import json_values as jv
from threadsift.functions.scalars import bound, rounded_between, trim_blank

CONTACT_FIELDS = ("name", "email", "company", "title", "phone_number")


def _last_position(text: Column, character: str) -> Column:
    return F.when(
        text.contains(character), F.length(text) - F.instr(F.reverse(text), character) + 1
    ).otherwise(0)


def _between(text: Column, opening: str, closing: str, otherwise: Column) -> Column:
    """From the first `opening` to the last `closing`, or `otherwise` when there is no such span."""
    start, end = F.instr(text, opening), _last_position(text, closing)
    return F.when((start > 0) & (end > start), F.substring(text, start, end - start + 1)).otherwise(otherwise)


def repaired_text(raw: Column) -> Column:
    """The reply without code fences, cut to its outermost array when it does not start with one."""
    plain = trim_blank(raw)
    plain = F.regexp_replace(plain, r"(?i)^```(?:json)?\s*\n?", "")
    plain = trim_blank(F.regexp_replace(plain, r"\n?```\s*\z", ""))
    return bound(plain, lambda t: F.when(t.startswith("["), t).otherwise(_between(t, "[", "]", t)))


def _only_array(value: Column) -> Column:
    """The single array among an object's values, NULL when there is none or more than one."""
    members = F.map_values(F.try_variant_get(value, "$", "map<string,variant>"))
    arrays = F.filter(members, jv.is_array)
    return F.when(jv.is_object(value) & (F.size(arrays) == 1), F.get(arrays, F.lit(0)))


def _parsed(text: Column) -> Column:
    """struct(items, error) of a repaired text, every step evaluated once."""

    def verdict(found: Column, error: Column) -> Column:
        """A list with a null element is as unusable as no list."""

        def check(items: Column) -> Column:
            whole = items.isNotNull() & ~F.coalesce(
                F.exists(items, lambda v: v.isNull() | F.is_variant_null(v)), F.lit(False)
            )
            return F.struct(
                F.when(whole, items).alias("items"), F.when(whole, F.lit(None)).otherwise(error).alias("error")
            )

        return bound(F.try_variant_get(found, "$", "array<variant>"), check)

    def from_value(value: Column) -> Column:
        return F.when(
            value.isNotNull(),
            verdict(F.when(jv.is_array(value), value).otherwise(_only_array(value)), F.lit(fixed.NOT_AN_ARRAY_ERROR)),
        ).otherwise(bound(_between(text, "{", "}", F.lit(None)), from_inner))

    def from_inner(inner: Column) -> Column:
        wrapped = bound(jv.parse_whole(inner), _only_array)
        missing = F.when(inner.isNull(), F.lit(fixed.NO_JSON_ERROR)).otherwise(F.lit(fixed.NO_SINGLE_ARRAY_ERROR))
        return verdict(wrapped, missing)

    return bound(jv.parse_whole(text), from_value)


def parse_replies(replies: DataFrame, raw: str = "raw") -> DataFrame:
    """Add `items` (array of VARIANT, NULL when unusable) and `parse_error`."""
    parsed = bound(repaired_text(F.coalesce(F.col(raw), F.lit(""))), _parsed)
    return (
        replies.withColumn("_parsed", parsed)
        .withColumns({"items": F.col("_parsed.items"), "parse_error": F.col("_parsed.error")})
        .drop("_parsed")
    )


def _score(value: Column) -> Column:
    low, high = fixed.SCORE_RANGE
    given = jv.number(value)
    number = F.when((given == 0) | given.isNull() | F.isnan(given), F.lit(float(fixed.DEFAULT_SCORE))).otherwise(given)
    return rounded_between(number, low, high)


def _contact(value: Column) -> Column:
    fields = [jv.text_or_null(jv.field(value, name)).alias(name) for name in CONTACT_FIELDS]
    return F.when(jv.truthy(value), F.struct(*fields))


def coerce_items(items: DataFrame, item: str = "item") -> DataFrame:
    """Turn each VARIANT item into the fixed reply fields (thread_id is the item's own)."""
    v = F.col(item)
    get = {
        name: jv.field(v, name)
        for name in (
            "thread_id is_deal is_english language ai_score category likely_scam ai_insight ai_summary "
            "main_contact deal_brand deal_type deal_name deal_value deal_currency"
        ).split()
    }
    deal = F.col("is_deal")
    staged = items.withColumn("is_deal", jv.truthy(get["is_deal"]))
    fields = {
        "own_thread_id": F.coalesce(jv.text_or_null(get["thread_id"]), F.lit("")),
        "is_english": ~F.coalesce(
            (jv.kind(get["is_english"]) == "BOOLEAN") & ~F.try_variant_get(v, "$.is_english", "boolean"), F.lit(False)
        ),
        "language": jv.text_or_null(get["language"]),
        "ai_score": _score(get["ai_score"]),
        "category": F.when(
            deal,
            F.when(jv.string_in(get["category"], fixed.CATEGORIES), jv.as_text(get["category"])).otherwise(
                fixed.DEFAULT_CATEGORY
            ),
        ),
        "likely_scam": jv.truthy(get["likely_scam"]) | jv.string_equals(get["category"], fixed.SCAM_CATEGORY),
        "ai_insight": F.coalesce(jv.text_or_null(get["ai_insight"]), F.lit("")),
        "ai_summary": F.substring(
            F.coalesce(jv.text_or_null(get["ai_summary"]), F.lit("")), 1, fixed.SUMMARY_MAX_CHARS
        ),
        "main_contact": F.when(deal, _contact(get["main_contact"])),
        "deal_brand": F.when(deal, jv.text_or_null(get["deal_brand"])),
        "deal_type": F.when(
            deal,
            F.when(jv.string_in(get["deal_type"], fixed.DEAL_TYPES), jv.as_text(get["deal_type"])).otherwise(
                fixed.DEFAULT_DEAL_TYPE
            ),
        ),
        "deal_name": F.when(deal, jv.text_or_null(get["deal_name"])),
        "deal_value": F.when(jv.exists(get["deal_value"]), jv.number(get["deal_value"])),
        "deal_currency": jv.text_or_null(get["deal_currency"]),
        "thread_index": F.when(
            jv.exists(jv.field(v, "thread_index")), jv.number(jv.field(v, "thread_index"))
        ),
        "has_index": jv.exists(jv.field(v, "thread_index")),
    }
    return staged.withColumns(fields).drop(item)


def attach_thread_ids(items: DataFrame, batch_order: DataFrame) -> DataFrame:
    """Resolve thread_index through the order of the batch.

    An index of 0 or less means the first thread; where it cannot be read or lies outside
    the batch, the item's own id counts.
    """
    order = batch_order.select("batch_id", F.col("thread_index").cast("double").alias("_index"), F.col("thread_id").alias("_ordered"))
    readable = F.col("has_index") & F.col("thread_index").isNotNull()
    index = F.when(readable, F.greatest(F.lit(1.0), F.col("thread_index")))
    return (
        items.withColumn("_index", index)
        .join(order, ["batch_id", "_index"], "left")
        .withColumn("thread_id", F.coalesce(F.nullif("_ordered", F.lit("")), F.col("own_thread_id")))
        .drop("_index", "_ordered", "own_thread_id", "has_index", "thread_index")
    )


def reply_items(parsed: DataFrame, batch_order: DataFrame | None = None) -> DataFrame:
    """One coerced row per item of every usable reply; `pos` is its place in the reply."""
    keep = [c for c in parsed.columns if c not in ("raw", "items", "parse_error")]
    # The outer form keeps Catalyst from parsing every reply a second time in a
    # "has items" filter below the generator.
    exploded = parsed.select(*keep, F.posexplode_outer("items").alias("pos", "item"))
    items = coerce_items(exploded.filter(F.col("pos").isNotNull()))
    if batch_order is None:
        return items.withColumnRenamed("own_thread_id", "thread_id").drop("has_index", "thread_index")
    return attach_thread_ids(items, batch_order)


def cached_threads(audits: DataFrame) -> DataFrame:
    """(batch_id, items): cached evaluations, NULL where the stored text does not parse.

    The stored JSON holds the threads under 'threads' or is itself the list.
    """
    value = jv.parse_whole(F.col("ai_evaluation"))
    under_key = jv.field(F.col("_v"), "threads")
    chosen = F.when(jv.truthy(under_key), under_key).otherwise(F.col("_v"))
    return audits.withColumn("_v", value).select(
        "batch_id", F.try_variant_get(chosen, "$", "array<variant>").alias("items")
    )


def first_usable_reply(parsed: DataFrame) -> DataFrame:
    """Per batch the earliest layer that parsed, with the model label to record.

    Layers rank cached, primary, corrective, fallback; a batch without a usable
    reply has NULL items and counts as failed.
    """
    rank = F.array_position(F.array(*[F.lit(layer) for layer in fixed.REPLY_LAYERS]), F.col("layer"))
    label = F.when(F.col("layer") == "corrective", F.concat("model", F.lit(fixed.CORRECTIVE_SUFFIX))).otherwise(
        F.col("model")
    )
    best = parsed.groupBy("batch_id").agg(
        F.min_by(
            F.struct("layer", label.alias("model_used"), "items"),
            F.when(F.col("items").isNotNull(), rank),
        ).alias("best")
    )
    return best.select(
        "batch_id",
        F.col("best.layer").alias("layer"),
        F.col("best.model_used").alias("model_used"),
        F.col("best.items").alias("items"),
    )


def reply_health(parsed: DataFrame) -> DataFrame:
    """Per run: how many batches parsed at once, after a correction, or not at all."""
    ok = F.col("items").isNotNull()
    batches = parsed.groupBy("run_id", "batch_id").agg(
        F.bool_or(ok & (F.col("layer") == "primary")).alias("clean"),
        F.bool_or(ok & (F.col("layer") == "corrective")).alias("corrected"),
    )
    runs = batches.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.count_if("clean").alias("batch_clean"),
        F.count_if(~F.col("clean") & F.col("corrected")).alias("batch_retry"),
        F.count_if(~F.col("clean") & ~F.col("corrected")).alias("batch_failed"),
    )
    return runs.select(
        "run_id",
        ((F.col("batch_failed") == 0) & (F.col("batch_retry") == 0)).alias("clean"),
        F.lit(False).alias("repaired"),
        (F.col("batch_retry") > 0).alias("corrective_retry"),
        (F.col("batch_failed") > 0).alias("failed"),
        "batch_count",
        "batch_clean",
        "batch_retry",
        "batch_failed",
    )
