"""Run quality and A/B comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.operators import compare, metrics
from threadsift.operators import replies as reply_ops
from threadsift.registry import query
from threadsift.registry.replies import HEALTH, run_replies

RUNS = "(SELECT DISTINCT run_id FROM f_predictions) r"


def _pick(order: str, source: str = "f_predictions") -> str:
    return f"""(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, thread_id ORDER BY pos {order}) AS rn
 FROM {source}) q WHERE rn = 1) p"""


def _full(source: str = "f_predictions", order: str = "DESC") -> str:
    """Every labelled thread in every run, with the answer if there is one."""
    return f"""(SELECT r.run_id, t.id, t.is_deal AS want_deal, t.category AS want_category, t.likely_scam AS want_scam,
 t.score_lo, t.score_hi, p.thread_id IS NOT NULL AS answered, p.is_deal, p.category, p.likely_scam, p.ai_score
FROM f_truth t CROSS JOIN (SELECT DISTINCT run_id FROM {source}) r
LEFT JOIN {_pick(order, source)} ON p.run_id = r.run_id AND p.thread_id = t.id) f"""


def _stats(column: str, prefix: str) -> str:
    column = f"CAST({column} AS DOUBLE)"
    return f"""ROUND(AVG({column}), 4) AS {prefix}_mean, ROUND(MIN({column}), 4) AS {prefix}_min,
 ROUND(MAX({column}), 4) AS {prefix}_max, ROUND(STDDEV_POP({column}), 4) AS {prefix}_stddev"""


def _detection_runs(source: str = "f_predictions") -> str:
    return f"""(SELECT run_id, recall, precision, CASE WHEN precision + recall > 0
  THEN 5 * precision * recall / (4 * precision + recall) ELSE 0 END AS f2, tp, fp, fn
 FROM (SELECT run_id, tp, fp, fn, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 1 END AS recall,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 1 END AS precision
  FROM (SELECT run_id, COUNT(*) FILTER (WHERE want_deal AND answered AND is_deal) AS tp,
   COUNT(*) FILTER (WHERE NOT want_deal AND answered AND is_deal) AS fp,
   COUNT(*) FILTER (WHERE want_deal AND NOT (answered AND is_deal)) AS fn FROM {_full(source)} GROUP BY run_id) a) b) d"""


def _detection(source: str = "f_predictions") -> str:
    return f"""SELECT {_stats('recall', 'recall')}, {_stats('precision', 'precision')}, {_stats('f2', 'f2')}
FROM {_detection_runs(source)}"""


@query("joi_16_truth_with_answers", f"""
SELECT run_id, id AS thread_id, want_deal, is_deal, category, likely_scam, ai_score, NOT answered AS is_missing
FROM {_full()}""")
def joi_16(t):
    return metrics.expected_and_answered(t.truth, t.predictions).select(
        "run_id", "thread_id", "want_deal", "is_deal", "category", "likely_scam", "ai_score", "is_missing"
    )


@query("joi_16b_answered_and_unanswered", f"""
SELECT run_id, COUNT(*) FILTER (WHERE answered) AS answered, COUNT(*) FILTER (WHERE NOT answered) AS unanswered,
 COUNT(*) FILTER (WHERE NOT answered AND want_deal) AS unanswered_deals FROM {_full()} GROUP BY run_id""")
def joi_16_counts(t):
    return metrics.unanswered_counts(t.truth, t.predictions)


@query("joi_16c_answered_threads", f"""
SELECT run_id, id AS thread_id, want_deal, is_deal, category, likely_scam, ai_score FROM {_full()} WHERE answered""")
def joi_16_answered(t):
    return metrics.answered_threads(t.truth, t.predictions).select(
        "run_id", "thread_id", "want_deal", "is_deal", "category", "likely_scam", "ai_score"
    )


@query("agg_7_score_stats", f"SELECT run_id, {_stats('ai_score', 'score')} FROM f_predictions GROUP BY run_id")
def agg_7(t):
    return t.predictions.groupBy("run_id").agg(*metrics.stats(F.col("ai_score").cast("double"), "score"))


@query("eva_1_detection", _detection())
def eva_1(t):
    return metrics.detection(t.truth, t.predictions)


@query("eva_1b_detection_by_run", f"SELECT run_id, tp, fp, fn FROM {_detection_runs()}")
def eva_1b(t):
    return metrics.detection_by_run(t.truth, t.predictions).select("run_id", "tp", "fp", "fn")


_FOUND = "want_deal AND want_category IS NOT NULL AND answered AND is_deal"


def _accuracy(source: str = "f_predictions") -> str:
    return f"""SELECT {_stats('share', 'accuracy')} FROM (SELECT run_id,
 CASE WHEN COUNT(*) FILTER (WHERE {_FOUND}) > 0 THEN CAST(COUNT(*) FILTER (WHERE {_FOUND} AND category = want_category) AS DOUBLE)
  / COUNT(*) FILTER (WHERE {_FOUND}) ELSE 1 END AS share FROM {_full(source)} GROUP BY run_id) a"""


def _categories(source: str = "f_predictions") -> str:
    return f"""SELECT want_category AS category, ground_truth_count, {_stats('share', 'accuracy')} FROM (
 SELECT run_id, want_category, COUNT(*) AS ground_truth_count,
  CASE WHEN COUNT(*) FILTER (WHERE {_FOUND}) > 0 THEN CAST(COUNT(*) FILTER (WHERE {_FOUND} AND category = want_category) AS DOUBLE)
   / COUNT(*) FILTER (WHERE {_FOUND}) ELSE 1 END AS share
 FROM {_full(source)} WHERE want_deal AND want_category IS NOT NULL GROUP BY run_id, want_category) a
GROUP BY want_category, ground_truth_count"""


@query("eva_2_category_accuracy", _accuracy())
def eva_2(t):
    return metrics.category_accuracy(t.truth, t.predictions)


@query("eva_2b_accuracy_per_category", _categories())
def eva_2b(t):
    return metrics.accuracy_per_category(t.truth, t.predictions)


def _in_range(source: str = "f_predictions") -> str:
    return f"""SELECT {_stats('share', 'in_range_rate')} FROM (SELECT run_id,
 CAST(COUNT(*) FILTER (WHERE ai_score BETWEEN score_lo AND score_hi) AS DOUBLE) / COUNT(*) AS share
 FROM {_full(source)} WHERE answered AND score_lo IS NOT NULL GROUP BY run_id) a"""


@query("eva_3_score_in_range", _in_range())
def eva_3(t):
    return metrics.score_in_range(t.truth, t.predictions)


def _scams(source: str = "f_predictions") -> str:
    return f"""SELECT {_stats('share', 'accuracy')}, MAX(total) AS total_scam_threads FROM (SELECT run_id, COUNT(*) AS total,
 CAST(COUNT(*) FILTER (WHERE answered AND likely_scam) AS DOUBLE) / COUNT(*) AS share
 FROM {_full(source)} WHERE want_scam GROUP BY run_id) a"""


@query("eva_4_scam_detection", _scams())
def eva_4(t):
    return metrics.scam_detection(t.truth, t.predictions)


def _per_thread(source: str = "f_predictions") -> str:
    return f"""SELECT id, want_deal, COUNT(*) FILTER (WHERE answered AND is_deal = want_deal) AS detection_correct,
 COUNT(*) FILTER (WHERE answered AND want_deal AND is_deal AND category = want_category) AS category_correct,
 COUNT(*) FILTER (WHERE answered AND ai_score BETWEEN score_lo AND score_hi) AS score_in_range,
 COUNT(*) FILTER (WHERE answered AND likely_scam = want_scam) AS scam_correct, COUNT(*) AS total_runs
FROM {_full(source, 'ASC')} GROUP BY id, want_deal"""


@query("eva_5_per_thread", _per_thread())
def eva_5(t):
    return metrics.per_thread(t.truth, t.predictions)


_HEALTH_ROWS = f"""(SELECT CASE WHEN batch_failed = 0 AND batch_retry = 0 THEN 1 ELSE 0 END AS clean, 0 AS repaired,
 CASE WHEN batch_retry > 0 THEN 1 ELSE 0 END AS retry, CASE WHEN batch_failed > 0 THEN 1 ELSE 0 END AS failed
FROM ({HEALTH}) h) x"""


def health(t):
    return reply_ops.reply_health(reply_ops.parse_replies(run_replies(t)))


@query("eva_6_json_health", f"""
SELECT {_stats('clean', 'clean_parse_rate')}, {_stats('repaired', 'repaired_rate')}, {_stats('retry', 'corrective_retry_rate')},
 CAST(SUM(failed) AS BIGINT) AS total_failures FROM {_HEALTH_ROWS}""")
def eva_6(t):
    return metrics.json_health(health(t))


def usage(t):
    """Token use of one call per document."""
    return t.documents.select((F.col("n_chars") % 1000).alias("input_tokens"), (F.col("doc_id") % 100).alias("output_tokens"))


_COST = """SELECT CAST(i AS BIGINT) AS total_input_tokens, CAST(o AS BIGINT) AS total_output_tokens,
 ROUND((i * CAST(0.000001 AS DOUBLE) + o * CAST(0.000002 AS DOUBLE)) / (SELECT COUNT(*) FROM f_truth), 6) AS avg_cost_per_thread
FROM (SELECT CAST(SUM(n_chars % 1000) AS DOUBLE) AS i, CAST(SUM(doc_id % 100) AS DOUBLE) AS o FROM documents) s"""


@query("agg_8_token_cost", _COST)
def agg_8(t):
    return metrics.cost(usage(t), t.truth)


@query("eva_7_report", f"""
SELECT 'big-model' AS model, (SELECT COUNT(*) FROM ({HEALTH}) h) AS runs, (SELECT COUNT(*) FROM {RUNS}) AS successful_runs,
 (SELECT COUNT(*) FROM f_truth) AS ground_truth_count, d.recall_mean, d.f2_mean, a.accuracy_mean AS category_accuracy,
 s.in_range_rate_mean, c.total_scam_threads, k.avg_cost_per_thread,
 (SELECT CAST(SUM(failed) AS BIGINT) FROM {_HEALTH_ROWS}) AS total_failures
FROM ({_detection()}) d, ({_accuracy()}) a, ({_in_range()}) s, ({_scams()}) c, ({_COST}) k""")
def eva_7(t):
    report = metrics.report(t.truth, t.predictions, health(t), usage(t), {"model": "big-model"})
    return report.select(
        "model",
        "runs",
        "successful_runs",
        "ground_truth_count",
        "detection.recall_mean",
        "detection.f2_mean",
        F.col("categorization.accuracy_mean").alias("category_accuracy"),
        "urgency_scoring.in_range_rate_mean",
        "scam_detection.total_scam_threads",
        "cost.avg_cost_per_thread",
        "json_health.total_failures",
    )


@query("eva_7b_report_categories", _categories())
def eva_7_categories(t):
    """The per-category map of the report, one row for each entry."""
    report = metrics.report(t.truth, t.predictions, health(t), usage(t))
    names = [f"accuracy_{k}" for k in ("mean", "min", "max", "stddev")]
    return report.select(F.explode("per_category").alias("category", "c")).select("category", "c.ground_truth_count", *[f"c.{n}" for n in names])


# ---- two variants: the first two runs against the others ---------------------------
_A = "(SELECT * FROM f_predictions WHERE run_id <= 2)"
_B = "(SELECT * FROM f_predictions WHERE run_id > 2)"


def variants(t):
    return t.predictions.filter("run_id <= 2"), t.predictions.filter("run_id > 2")


def _metric_rows(source: str) -> str:
    return f"""
SELECT 'recall' AS metric, recall_mean AS value FROM ({_detection(source)}) d
UNION ALL SELECT 'precision', precision_mean FROM ({_detection(source)}) d
UNION ALL SELECT 'f2', f2_mean FROM ({_detection(source)}) d
UNION ALL SELECT 'recall_stddev', recall_stddev FROM ({_detection(source)}) d
UNION ALL SELECT 'category_accuracy', accuracy_mean FROM ({_accuracy(source)}) a
UNION ALL SELECT 'score_in_range', in_range_rate_mean FROM ({_in_range(source)}) s
UNION ALL SELECT 'scam_detection', accuracy_mean FROM ({_scams(source)}) c"""


_WINNER = "CASE WHEN delta > 0.001 THEN 'b' WHEN delta < -0.001 THEN 'a' ELSE 'tie' END AS winner"
_COMPARED = f"""SELECT metric, a, b, delta, {_WINNER} FROM (
 SELECT x.metric, ROUND(x.value, 4) AS a, ROUND(y.value, 4) AS b, ROUND(y.value - x.value, 4) AS delta
 FROM ({_metric_rows(_A)}) x JOIN ({_metric_rows(_B)}) y ON y.metric = x.metric) z"""


@query("eva_8_compare_metrics", _COMPARED)
def eva_8(t):
    a, b = variants(t)
    return compare.compare_metrics(compare.metric_table(t.truth, a), compare.metric_table(t.truth, b))


@query("eva_8b_compare_health_and_cost", f"""
SELECT metric, a, a AS b, CAST(0 AS DOUBLE) AS delta, 'tie' AS winner FROM (
 SELECT 'clean_parse_rate' AS metric, ROUND(AVG(clean), 4) AS a FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'corrective_retry_rate', ROUND(AVG(retry), 4) FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'total_failures', CAST(SUM(failed) AS DOUBLE) FROM {_HEALTH_ROWS}
 UNION ALL SELECT 'cost', ROUND(avg_cost_per_thread, 4) FROM ({_COST}) k) m""")
def eva_8b(t):
    table = compare.metric_table(t.truth, t.predictions, health(t), usage(t))
    extra = table.filter(F.col("metric").isin("clean_parse_rate", "corrective_retry_rate", "total_failures", "cost"))
    return compare.compare_metrics(extra, extra)


@query("set_1_categories_of_both_variants", """
SELECT DISTINCT category FROM f_truth WHERE is_deal AND category IS NOT NULL
UNION SELECT DISTINCT category FROM f_predictions WHERE category IS NOT NULL""")
def set_1(t):
    wanted = t.truth.filter(F.col("is_deal") & F.col("category").isNotNull()).select("category")
    return wanted.union(t.predictions.filter(F.col("category").isNotNull()).select("category")).distinct()


@query("joi_17_compare_categories", f"""
SELECT category, a, b, delta, {_WINNER}, a_count, b_count FROM (
 SELECT COALESCE(x.category, y.category) AS category, ROUND(COALESCE(x.accuracy_mean, 0), 4) AS a,
  ROUND(COALESCE(y.accuracy_mean, 0), 4) AS b, ROUND(COALESCE(y.accuracy_mean, 0) - COALESCE(x.accuracy_mean, 0), 4) AS delta,
  COALESCE(x.ground_truth_count, 0) AS a_count, COALESCE(y.ground_truth_count, 0) AS b_count
 FROM (SELECT * FROM ({_categories(_A)}) c WHERE category <> 'completed') x
 FULL JOIN ({_categories(_B)}) y ON y.category = x.category) z""")
def joi_17(t):
    a, b = variants(t)
    left = metrics.accuracy_per_category(t.truth, a).filter(F.col("category") != "completed")
    return compare.compare_categories(left, metrics.accuracy_per_category(t.truth, b))


_REGRESSED = f"""
SELECT id, kind FROM (
 SELECT x.id, unnest([CASE WHEN x.detection_correct = x.total_runs AND y.detection_correct < y.total_runs AND x.want_deal THEN 'missed_deal' END,
  CASE WHEN x.scam_correct = x.total_runs AND y.scam_correct < y.total_runs THEN 'missed_scam' END,
  CASE WHEN x.category_correct > y.category_correct THEN 'category' END]) AS kind
 FROM ({_per_thread(_A)}) x JOIN ({_per_thread(_B)}) y ON y.id = x.id) k WHERE kind IS NOT NULL"""


def regressed(t):
    a, b = variants(t)
    return compare.regressions(metrics.per_thread(t.truth, a), metrics.per_thread(t.truth, b))


@query("eva_9_regressions", _REGRESSED)
def eva_9(t):
    return regressed(t)


_VERDICT = f"""
SELECT *, CASE WHEN b_recall_above_95 AND b_precision_above_40 AND b_f2_above_baseline AND b_consistency_within_3pct
  AND no_new_missed_deals AND b_scam_no_regression AND b_category_no_regression THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT
 (SELECT b FROM ({_COMPARED}) c WHERE metric = 'recall') >= 0.95 AS b_recall_above_95,
 (SELECT b FROM ({_COMPARED}) c WHERE metric = 'precision') >= 0.4 AS b_precision_above_40,
 (SELECT b >= a FROM ({_COMPARED}) c WHERE metric = 'f2') AS b_f2_above_baseline,
 (SELECT b FROM ({_COMPARED}) c WHERE metric = 'recall_stddev') <= 0.03 AS b_consistency_within_3pct,
 NOT EXISTS (SELECT 1 FROM ({_REGRESSED}) r WHERE kind = 'missed_deal') AS no_new_missed_deals,
 NOT EXISTS (SELECT 1 FROM ({_REGRESSED}) r WHERE kind = 'missed_scam') AS b_scam_no_regression,
 (SELECT b >= a FROM ({_COMPARED}) c WHERE metric = 'category_accuracy') AS b_category_no_regression) v"""


@query("eva_10_verdict", _VERDICT)
def eva_10(t):
    a, b = variants(t)
    comparison = compare.compare_metrics(compare.metric_table(t.truth, a), compare.metric_table(t.truth, b))
    return compare.verdict(comparison, regressed(t))
