"""Labelled threads and saved results as JSON, and plain functions over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadsift.functions import scalars
from threadsift.functions.headers import address, has_header
from threadsift.operators import compare, mails, metrics
from threadsift.registry import query
from threadsift.registry.evaluation import _A, _B, _COMPARED, _COST, _HEALTH_ROWS, _REGRESSED, _VERDICT, _WINNER, _categories, health, usage, variants
from threadsift.session import materialize, shared_folder
from threadsift.sources import documents


def truth_documents(t):
    """The labelled mails as ground-truth documents: one thread per label with its mail."""
    mail = F.struct(
        F.col("message_id").alias("messageId"),
        F.col("thread_id").alias("threadId"),
        F.col("headers").alias("topLevelHeaders"),
        F.when(F.col("quality") == 0, F.lit(" \n")).otherwise(F.col("body")).alias("body"),
    )
    expected = F.struct(
        (F.col("quality") == 1).alias("is_deal"),
        F.when(F.col("quality") == 1, F.lit("new")).alias("category"),
        (F.col("toxic") == 1).alias("likely_scam"),
        F.when(F.col("toxic") == 0, F.array(F.lit(1), F.lit(4))).alias("score_range"),
    )
    labelled = t.labels.join(t.mails.withColumn("doc_id", F.col("k")), "doc_id")
    return labelled.select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("labelled").alias("description"),
        F.array(mail).alias("emails"),
        expected.alias("expected"),
    )


def stored_truth(t):
    path = f"{shared_folder(t.spark)}/truth-{uuid.uuid4().hex}"
    truth_documents(t).write.json(path)
    return documents.read_truth(t.spark, path, one_per_line=True)


@query("src_4_labelled_threads", """
SELECT CAST(doc_id AS STRING) AS id, quality = 1 AS is_deal, CASE WHEN quality = 1 THEN 'new' END AS category,
 toxic = 1 AS likely_scam, CASE WHEN toxic = 0 THEN 1 END AS score_lo, CASE WHEN toxic = 0 THEN 4 END AS score_hi FROM labels""")
def src_4(t):
    return documents.labels_of(stored_truth(t))


@query("flt_8_usable_truth", """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE quality = 0) AS empty_body,
 COUNT(*) FILTER (WHERE quality = 1 AND rejected) AS static_filtered, COUNT(*) FILTER (WHERE quality = 1 AND NOT rejected) AS usable
FROM (SELECT l.quality, (auth_value IS NOT NULL AND NOT CONTAINS(auth_value, 'dkim=pass')) OR list_id_value IS NOT NULL
 OR precedence_value IS NOT NULL OR x_mailer_value = 'MailChimp Mailer' OR LOWER(subject_value) IN ('weekly digest', 'promotion inside')
 OR from_value IN ('No-Reply@brand.com', '"The Team" <x@brand.com>', 'Bo <bo@news.brand.com>', 'info12@gmail.com', 'promo9@yahoo.net',
  'Digest <d@brand.com>', 'ev@agency.gov') AS rejected
 FROM labels l JOIN f_emails e ON e.k = l.doc_id) x""")
def flt_8(t):
    return mails.usable_truth_counts(stored_truth(t))


def saved_results(t):
    """Both variants' reports as the JSON texts an evaluation run leaves behind."""

    def stat(source: str, name: str):
        return F.struct(*[F.col(f"{source}.{name}_{k}").alias(k) for k in ("mean", "min", "max", "stddev")]).alias(name)

    calls = materialize(health(t))  # the same in both variants: its replies are parsed once

    def text(predictions, variant: str):
        report = metrics.report(t.truth, predictions, calls, usage(t), {"model": variant})
        document = F.struct(
            "model",
            "runs",
            "successful_runs",
            F.struct(*[stat("detection", n) for n in ("recall", "precision", "f2")]).alias("detection"),
            F.struct(
                stat("categorization", "accuracy"),
                F.transform_values(
                    "per_category",
                    lambda _, c: F.struct(
                        c["accuracy_mean"].alias("mean"), c["ground_truth_count"].alias("ground_truth_count")
                    ),
                ).alias("per_category"),
            ).alias("categorization"),
            F.struct(stat("urgency_scoring", "in_range_rate")).alias("urgency_scoring"),
            F.struct(stat("scam_detection", "accuracy")).alias("scam_detection"),
            F.struct(
                stat("json_health", "clean_parse_rate"),
                stat("json_health", "corrective_retry_rate"),
                F.col("json_health.total_failures").alias("total_failures"),
            ).alias("json_health"),
            F.struct(F.col("cost.avg_cost_per_thread").alias("avg_cost_per_thread")).alias("cost"),
        )
        # Without the per-thread list: regressions of a large truth set read its table.
        return report.select(F.lit(variant).alias("variant"), F.to_json(document).alias("text"))

    a, b = variants(t)
    return text(a, "a").unionByName(text(b, "b"))


def compared_results(t):
    values = documents.result_metrics(documents.parse_results(saved_results(t)))
    return compare.compare_metrics(
        values.filter("variant = 'a'").drop("variant"), values.filter("variant = 'b'").drop("variant")
    )


@query("src_5_saved_results", _COMPARED)
def src_5(t):
    kept = ["recall", "precision", "f2", "recall_stddev", "category_accuracy", "score_in_range", "scam_detection"]
    return compared_results(t).filter(F.col("metric").isin(kept))


# The whole comparison: health and cost are of the same calls in both variants.
@query("src_5b_all_saved_results", f"""
{_COMPARED}
UNION ALL SELECT metric, v AS a, v AS b, CAST(0 AS DOUBLE) AS delta, 'tie' AS winner FROM (
 SELECT 'clean_parse_rate' AS metric, ROUND(AVG(clean), 4) AS v FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'corrective_retry_rate', ROUND(AVG(retry), 4) FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'total_failures', CAST(SUM(failed) AS DOUBLE) FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'cost', ROUND(avg_cost_per_thread, 4) FROM ({_COST}) k) m""")
def src_5b(t):
    return compared_results(t)


def saved_variants(t):
    """Both variants saved as versions of their own, and read again: (result, per-thread table) of each."""
    root = f"{shared_folder(t.spark)}/results-{uuid.uuid4().hex}"
    calls = materialize(health(t))  # the same in both variants: its replies are parsed once
    out = []
    for name, predictions in zip("ab", variants(t)):
        report = metrics.report(t.truth, predictions, calls, usage(t), {"model": name})
        threads = metrics.per_thread(t.truth, predictions, keep=["category", "likely_scam", "score_lo", "score_hi"])
        documents.save_result(report, threads, root, name)
        out.append(documents.read_result(t.spark, root, name))
    return out


def _saved_comparison(t):
    (result_a, threads_a), (result_b, threads_b) = saved_variants(t)
    metric_a, metric_b = (documents.result_metrics(r).drop("variant") for r in (result_a, result_b))
    return compare.compare_metrics(metric_a, metric_b), compare.regressions(threads_a, threads_b)


@query("eva_9b_saved_regressions", _REGRESSED)
def eva_9_saved(t):
    return _saved_comparison(t)[1]


@query("eva_10b_saved_verdict", _VERDICT)
def eva_10_saved(t):
    return compare.verdict(*_saved_comparison(t))


@query("joi_17b_saved_categories", f"""
SELECT category, a, b, delta, {_WINNER}, a_count, b_count FROM (
 SELECT x.category, ROUND(x.accuracy_mean, 4) AS a, ROUND(y.accuracy_mean, 4) AS b, ROUND(y.accuracy_mean - x.accuracy_mean, 4) AS delta,
  x.ground_truth_count AS a_count, y.ground_truth_count AS b_count
 FROM ({_categories(_A)}) x JOIN ({_categories(_B)}) y ON y.category = x.category) z""")
def joi_17_saved(t):
    (result_a, _), (result_b, _) = saved_variants(t)
    return compare.compare_categories(*[documents.result_categories(r) for r in (result_a, result_b)])


# ---- plain functions --------------------------------------------------------------------
@query("sca_1_text_functions", """
SELECT email_metadata_id, LOWER(TRIM(sender_email)) AS email, STARTS_WITH(LOWER(TRIM(sender_email)), 'no-') AS starts,
 CONTAINS(sender_email, '@Brand') AS has_brand,
 CASE WHEN CONTAINS(sender_email, '@') THEN SUBSTR(LOWER(TRIM(sender_email)), STRPOS(LOWER(TRIM(sender_email)), '@') + 1) ELSE '' END AS domain
FROM f_senders""")
def sca_1(t):
    email = address(F.col("sender_email"))
    return t.senders.select(
        "email_metadata_id",
        email.alias("email"),
        email.startswith("no-").alias("starts"),
        F.contains("sender_email", F.lit("@Brand")).alias("has_brand"),
        F.when(email.contains("@"), F.substring(email, F.instr(email, "@") + 1, F.length(email))).otherwise("").alias("domain"),
    )


@query("sca_2_patterns", r"""
SELECT page_id, REGEXP_MATCHES(url, '^https') AS secure, REGEXP_EXTRACT(url, '^https?://([^/]+)', 1) AS host,
 REGEXP_REPLACE(html, '(?i)<[^>]*>', '', 'g') AS bare FROM pages""")
def sca_2(t):
    return t.pages.select(
        "page_id",
        F.col("url").rlike("^https").alias("secure"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_replace("html", "(?i)<[^>]*>", "").alias("bare"),
    )


@query("sca_7_clock_arithmetic", """
SELECT event_id, ts - 5 * INTERVAL '1' MINUTE AS five_minutes_before, ts + 1500 * INTERVAL '1' MILLISECOND AS later FROM events""")
def sca_7(t):
    from threadsift.functions.scalars import minutes_before

    return t.events.select(
        "event_id",
        minutes_before(F.col("ts"), 5).alias("five_minutes_before"),
        F.timestamp_add("MILLISECOND", F.lit(1500), F.col("ts")).alias("later"),
    )


@query("sca_8_rounding", """
SELECT event_id, CAST(FLOOR(LEAST(10, GREATEST(1, value / 20 + 0.5))) AS INTEGER) AS score FROM events""")
def sca_8(t):
    return t.events.select(
        "event_id",
        scalars.rounded_between(F.col("value") / 20, 1, 10).alias("score"),
    )


@query("sca_10_defaults", """
SELECT user_id, COALESCE(NULLIF(integer_value, ''), CAST(CAST(double_value AS BIGINT) AS STRING), 'none') AS marker,
 CASE WHEN integer_value NOT IN ('0', 'not-a-timestamp') THEN 'set' ELSE 'unset' END AS kind FROM f_markers""")
def sca_10(t):
    return t.markers.select(
        "user_id",
        scalars.first_given(F.col("integer_value"), F.col("double_value").cast("bigint"), default="none").alias("marker"),
        F.when(~F.col("integer_value").isin("0", "not-a-timestamp"), "set").otherwise("unset").alias("kind"),
    )


@query("sca_11_json_fields", """
SELECT event_id, CAST(REGEXP_EXTRACT(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k, '{"id":' || CAST(event_id AS STRING) || '}' AS text
FROM events""")
def sca_11(t):
    from threadsift.functions import json_values as jv

    return t.events.select(
        "event_id",
        jv.number(jv.field(jv.parse_whole(F.col("props")), "k")).alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"))).alias("text"),
    )


@query("sca_12_arrays", """
SELECT k, CAST(LEN([x for x in [from_value, subject_value, auth_value, list_id_value, precedence_value, x_mailer_value, date_value]
  if x IS NOT NULL]) AS INTEGER) AS n_headers,
 auth_value IS NOT NULL AS has_auth, list_id_value IS NULL AND precedence_value IS NULL AS no_bulk FROM f_emails""")
def sca_12(t):
    bulk = ["list-id", "precedence"]
    return t.mails.select(
        "k",
        F.size("headers").alias("n_headers"),
        has_header(F.col("headers"), "Authentication-Results").alias("has_auth"),
        (~has_header(F.col("headers"), *bulk)).alias("no_bulk"),
    )
