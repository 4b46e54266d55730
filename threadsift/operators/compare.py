"""Two evaluation results side by side: metric deltas, regressions, verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.operators import metrics


def compared(a: Column, b: Column) -> list[Column]:
    """a, b, delta to 4 digits and the winner; small differences are a tie."""
    delta = F.round(b - a, 4)
    winner = F.when(delta > fixed.WINNER_MARGIN, "b").when(delta < -fixed.WINNER_MARGIN, "a").otherwise("tie")
    return [F.round(a, 4).alias("a"), F.round(b, 4).alias("b"), delta.alias("delta"), winner.alias("winner")]


def metric_table(
    truth: DataFrame, predictions: DataFrame, health: DataFrame | None = None, usage: DataFrame | None = None
) -> DataFrame:
    """One variant's headline metrics as (metric, value)."""
    named = [
        (
            metrics.headline(truth, predictions),
            {
                "recall": "detection.recall_mean",
                "precision": "detection.precision_mean",
                "f2": "detection.f2_mean",
                "recall_stddev": "detection.recall_stddev",
                "category_accuracy": "categorization.accuracy_mean",
                "score_in_range": "urgency_scoring.in_range_rate_mean",
                "scam_detection": "scam_detection.accuracy_mean",
            },
        )
    ]
    if health is not None:
        named.append(
            (
                metrics.json_health(health),
                {
                    "clean_parse_rate": "clean_parse_rate_mean",
                    "corrective_retry_rate": "corrective_retry_rate_mean",
                    "total_failures": "total_failures",
                },
            )
        )
    if usage is not None:
        named.append((metrics.cost(usage, truth), {"cost": "avg_cost_per_thread"}))
    table = None
    for frame, names in named:
        entries = [
            F.struct(F.lit(metric).alias("metric"), F.col(column).cast("double").alias("value"))
            for metric, column in names.items()
        ]
        rows = frame.select(F.explode(F.array(*entries)).alias("e")).select("e.metric", "e.value")
        table = rows if table is None else table.unionByName(rows)
    return table


def compare_metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two metric tables joined into one comparison."""
    left = a.select("metric", F.col("value").alias("_a"))
    right = b.select("metric", F.col("value").alias("_b"))
    return left.join(right, "metric").select("metric", *compared(F.col("_a"), F.col("_b")))


def compare_categories(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per-category accuracy of both variants; a category one side lacks counts 0 there."""
    left = a.select("category", F.col("accuracy_mean").alias("_a"), F.col("ground_truth_count").alias("a_count"))
    right = b.select("category", F.col("accuracy_mean").alias("_b"), F.col("ground_truth_count").alias("b_count"))
    joined = left.join(right, "category", "full").na.fill(0, ["_a", "_b", "a_count", "b_count"])
    return joined.select("category", *compared(F.col("_a"), F.col("_b")), "a_count", "b_count")


def regressions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Threads of both per-thread tables that got worse, with the kind of regression."""
    renamed = {c: f"b_{c}" for c in ("detection_correct", "category_correct", "scam_correct", "total_runs")}
    right = b.select("id", *[F.col(old).alias(new) for old, new in renamed.items()])

    def newly_missed(count: str) -> Column:
        return (F.col(count) == F.col("total_runs")) & (F.col(f"b_{count}") < F.col("b_total_runs"))

    kinds = F.array_compact(
        F.array(
            F.when(newly_missed("detection_correct") & F.col("want_deal"), "missed_deal"),
            F.when(newly_missed("scam_correct"), "missed_scam"),
            F.when(F.col("category_correct") > F.col("b_category_correct"), "category"),
        )
    )
    return a.join(right, "id").select("id", F.explode(kinds).alias("kind"))


def verdict(comparison: DataFrame, regressed: DataFrame) -> DataFrame:
    """One row of checks and PASS or FAIL.

    `comparison` needs the metrics recall, precision, f2, recall_stddev and category_accuracy.
    """
    def metric(name: str, side: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col(side)))

    kinds = ("missed_deal", "missed_scam")
    regressed_count = regressed.agg(F.struct(*[F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds]).alias("n")).scalar()

    checks = comparison.agg(
        (metric("recall", "b") >= fixed.MIN_RECALL).alias("b_recall_above_95"),
        (metric("precision", "b") >= fixed.MIN_PRECISION).alias("b_precision_above_40"),
        (metric("f2", "b") >= metric("f2", "a")).alias("b_f2_above_baseline"),
        (metric("recall_stddev", "b") <= fixed.MAX_RECALL_STDDEV).alias("b_consistency_within_3pct"),
        (metric("category_accuracy", "b") >= metric("category_accuracy", "a")).alias("b_category_no_regression"),
    ).withColumns(
        {
            "no_new_missed_deals": regressed_count["missed_deal"] == 0,
            "b_scam_no_regression": regressed_count["missed_scam"] == 0,
        }
    )
    passed = None
    for name in checks.columns:
        ok = F.coalesce(F.col(name), F.lit(False))
        passed = ok if passed is None else passed & ok
    return checks.withColumn("verdict", F.when(passed, "PASS").otherwise("FAIL"))
