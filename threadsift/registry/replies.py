"""Model replies: repair, coercion, layers and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.operators import replies as ops
from threadsift.registry import query
from threadsift.registry import reply_inputs as given

COERCED = """
SELECT batch_id, thread_index, thread_id, shape, is_deal, lang = 'en' AS is_english,
 CASE WHEN lang <> 'en' THEN lang END AS language,
 CAST(CASE WHEN ai_score = 0 THEN 5 WHEN ai_score > 10 THEN 10 ELSE ai_score END AS INTEGER) AS ai_score,
 CASE WHEN is_deal THEN CASE WHEN category = 'weird' THEN 'low_confidence' ELSE category END END AS category,
 category = 'likely_scam' AS likely_scam, 'insight' AS ai_insight, SUBSTR(ai_summary, 1, 1000) AS ai_summary,
 CASE WHEN is_deal THEN NULLIF(contact_email, '') END AS contact_email,
 CASE WHEN is_deal THEN NULLIF(contact_name, '') END AS contact_name,
 CASE WHEN is_deal THEN 'Brand' END AS contact_company,
 CASE WHEN is_deal THEN 'Brand' END AS deal_brand,
 CASE WHEN is_deal THEN CASE WHEN deal_type = 'odd' THEN 'other_business' ELSE deal_type END END AS deal_type,
 CASE WHEN is_deal THEN 'Deal “' || thread_id || '”' END AS deal_name,
 CAST(deal_value AS DOUBLE) AS deal_value, 'EUR' AS deal_currency
FROM f_replies"""
_FIELDS = (
    "batch_id thread_id is_deal is_english language ai_score category likely_scam ai_insight ai_summary "
    "contact_email contact_name contact_company deal_brand deal_type deal_name deal_value deal_currency"
).split()


def flat(items):
    return items.withColumns(
        {
            "contact_email": F.col("main_contact.email"),
            "contact_name": F.col("main_contact.name"),
            "contact_company": F.col("main_contact.company"),
        }
    ).select(*_FIELDS)


def parsed_batches(t):
    return ops.parse_replies(given.raw_batches(t.replies).drop("json"))


def items(t):
    """Coerced items of every reply that parses, with the thread id from the batch order."""
    return ops.reply_items(parsed_batches(t).drop("shape"), given.batch_order(t.replies))


@query("rep_1_parse_replies", """
SELECT batch_id, CASE WHEN shape = 'broken' THEN NULL ELSE COUNT(*) END AS items,
 CASE WHEN shape = 'broken' THEN 'Cannot extract JSON array from response' END AS parse_error
FROM f_replies GROUP BY batch_id, shape""")
def rep_1(t):
    return parsed_batches(t).select("batch_id", F.size("items").cast("bigint").alias("items"), "parse_error").withColumn(
        "items", F.when(F.col("parse_error").isNull(), F.col("items"))
    )


@query("rep_2_coerced_items", f"SELECT {', '.join(_FIELDS)} FROM ({COERCED}) c WHERE shape <> 'broken'")
def rep_2(t):
    return flat(items(t))


@query("rep_3_thread_ids", "SELECT batch_id, thread_id FROM f_replies WHERE shape <> 'broken'")
def rep_3(t):
    return items(t).select("batch_id", "thread_id")


_LAYER = """
SELECT DISTINCT batch_id, CASE WHEN shape <> 'broken' THEN 'primary' WHEN batch_id % 16 = 3 THEN 'corrective'
 WHEN batch_id % 16 < 12 THEN 'fallback' END AS layer FROM f_replies"""


@query("rep_4_first_usable_reply", f"""
SELECT batch_id, layer, CASE layer WHEN 'primary' THEN 'big-model' WHEN 'corrective' THEN 'big-model(corrective-retry)'
 WHEN 'fallback' THEN 'small-model' END AS model_used FROM ({_LAYER}) l""")
def rep_4(t):
    parsed = ops.parse_replies(given.layered(t.replies))
    return ops.first_usable_reply(parsed).select("batch_id", "layer", "model_used")


# Every second batch has a stored audit; what can be read of them comes before any reply.
@query("rep_4b_cached_replies_first", f"""
SELECT l.batch_id, CASE WHEN c.batch_id IS NOT NULL THEN 'cached' ELSE layer END AS layer,
 CASE WHEN c.batch_id IS NOT NULL THEN NULL WHEN layer = 'primary' THEN 'big-model' WHEN layer = 'corrective' THEN 'big-model(corrective-retry)'
 WHEN layer = 'fallback' THEN 'small-model' END AS model_used
FROM ({_LAYER}) l LEFT JOIN (SELECT DISTINCT batch_id FROM f_replies WHERE shape <> 'broken' AND batch_id % 2 = 0) c ON c.batch_id = l.batch_id""")
def rep_4_cached(t):
    stored = ops.cached_threads(given.audits(t.replies).filter("batch_id % 2 = 0"))
    cached = stored.select("batch_id", F.lit("cached").alias("layer"), F.lit(None).cast("string").alias("model"), "items")
    parsed = ops.parse_replies(given.layered(t.replies)).select("batch_id", "layer", "model", "items")
    return ops.first_usable_reply(parsed.unionByName(cached)).select("batch_id", "layer", "model_used")


def run_replies(t):
    """The layered replies as three runs; the last run has no corrections."""
    layers = given.layered(t.replies).filter(F.col("layer") != "fallback")
    runs = layers.withColumn("run_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return runs.filter((F.col("run_id") < 3) | (F.col("layer") == "primary"))


HEALTH = """
SELECT run_id, COUNT(*) AS batch_count, COUNT(*) FILTER (WHERE shape <> 'broken') AS batch_clean,
 COUNT(*) FILTER (WHERE shape = 'broken' AND batch_id % 16 = 3 AND run_id < 3) AS batch_retry,
 COUNT(*) FILTER (WHERE shape = 'broken' AND NOT (batch_id % 16 = 3 AND run_id < 3)) AS batch_failed
FROM (SELECT DISTINCT batch_id, shape, unnest([1, 2, 3]) AS run_id FROM f_replies) b GROUP BY run_id"""


@query("rep_5_reply_health", f"""
SELECT run_id, batch_failed = 0 AND batch_retry = 0 AS clean, FALSE AS repaired, batch_retry > 0 AS corrective_retry,
 batch_failed > 0 AS failed, batch_count, batch_clean, batch_retry, batch_failed FROM ({HEALTH}) h""")
def rep_5(t):
    return ops.reply_health(ops.parse_replies(run_replies(t)))


@query("src_7_cached_replies", """
SELECT batch_id, CASE WHEN shape = 'broken' THEN NULL ELSE COUNT(*) END AS threads FROM f_replies GROUP BY batch_id, shape""")
def src_7(t):
    cached = ops.cached_threads(given.audits(t.replies))
    return cached.select(
        "batch_id", F.when(F.col("items").isNotNull(), F.size("items")).cast("bigint").alias("threads")
    )
