"""Nested JSON inputs: rule lists, labelled threads, saved evaluation results."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.functions.rules import RuleLists
from threadsift.sources.tables import _children, versions


def read_rule_lists(spark: SparkSession, path: str) -> RuleLists:
    """Rule lists from one JSON object whose keys are the list names; lists it lacks keep
    their default. The lists are configuration of fixed, small size."""
    names = [f.name for f in fields(RuleLists)]
    schema = ", ".join(f"{name} ARRAY<STRING>" for name in names)
    row = spark.read.schema(schema).json(path, multiLine=True).first()
    given = {name: tuple(row[name]) for name in names if row is not None and row[name] is not None}
    return RuleLists(**given)


def read_truth(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Labelled threads from JSON, mails in message shape.

    A hand-made file is one JSON array; a large set has one object per line, which
    Spark can split.
    """
    raw = spark.read.schema(schemas.TRUTH).json(path, multiLine=not one_per_line)
    emails = F.transform(
        "emails",
        lambda e: F.struct(
            e["messageId"].alias("message_id"),
            e["id"].alias("id"),
            e["threadId"].alias("thread_id"),
            e["previousAiSummary"].alias("previous_ai_summary"),
            e["topLevelHeaders"].alias("headers"),
            e["body"].alias("body"),
            e["replyBody"].alias("reply_body"),
        ),
    )
    return raw.select("id", "description", emails.alias("emails"), "expected")


def labels_of(truth: DataFrame) -> DataFrame:
    """Flat expectations as the metrics read them."""
    bounds = F.col("expected.score_range")
    return truth.select(
        "id",
        F.coalesce(F.col("expected.is_deal"), F.lit(False)).alias("is_deal"),
        F.col("expected.category").alias("category"),
        F.coalesce(F.col("expected.likely_scam"), F.lit(False)).alias("likely_scam"),
        F.get(bounds, F.lit(0)).alias("score_lo"),
        F.get(bounds, F.lit(1)).alias("score_hi"),
    )


def _stats(source: str, name: str) -> Column:
    return F.struct(*[F.col(f"{source}.{name}_{k}").alias(k) for k in ("mean", "min", "max", "stddev")]).alias(name)


def result_document(report: DataFrame) -> DataFrame:
    """The one-row report of `metrics.report` in the shape of a saved result, without the per-thread list."""

    def category(c: Column) -> Column:
        return F.struct(*[c[f"accuracy_{k}"].alias(k) for k in ("mean", "min", "max", "stddev")], c["ground_truth_count"].alias("ground_truth_count"))

    named = [c for c in ("model",) if c in report.columns]
    return report.select(
        *named,
        "runs",
        "successful_runs",
        "ground_truth_count",
        F.struct(*[_stats("detection", n) for n in ("recall", "precision", "f2")]).alias("detection"),
        F.struct(_stats("categorization", "accuracy"), F.transform_values("per_category", lambda _, c: category(c)).alias("per_category")).alias("categorization"),
        F.struct(_stats("urgency_scoring", "in_range_rate")).alias("urgency_scoring"),
        F.struct(_stats("scam_detection", "accuracy"), F.col("scam_detection.total_scam_threads").alias("total_scam_threads")).alias("scam_detection"),
        F.struct(*[_stats("json_health", n) for n in ("clean_parse_rate", "repaired_rate", "corrective_retry_rate")], F.col("json_health.total_failures").alias("total_failures")).alias("json_health"),
        "cost",
    )


def save_result(report: DataFrame, threads: DataFrame, root: str, name: str) -> int:
    """Save an evaluation as the next version of `name`: the report, and its per-thread table beside it.

    `threads` is a table of any size (`metrics.per_thread`). The report is written last, and
    a version counts from then on, so both are always read from one run.
    """
    spark = report.sparkSession
    folder = f"{root}/{name}"
    taken = [int(c.split("=")[1]) for part in ("threads", "report") for c in _children(spark, f"{folder}/{part}") if c.startswith("v=")]
    version = max(taken, default=0) + 1
    threads.write.mode("errorifexists").parquet(f"{folder}/threads/v={version}")
    result_document(report).coalesce(1).write.mode("errorifexists").json(f"{folder}/report/v={version}")
    return version


def read_result(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(one row: variant, result; per-thread table) of the newest complete version of a saved evaluation."""
    known = versions(spark, root, f"{name}/report")
    if not known:
        raise FileNotFoundError(f"missing evaluation result: {name}")
    folder, version = f"{root}/{name}", known[-1]
    report = spark.read.schema(schemas.EVAL_RESULT).json(f"{folder}/report/v={version}")
    result = report.select(F.lit(name).alias("variant"), F.struct(*report.columns).alias("result"))
    return result, spark.read.parquet(f"{folder}/threads/v={version}")


def parse_results(results: DataFrame) -> DataFrame:
    """(variant, result): saved evaluation results from JSON text.

    `results`: variant ('a' or 'b'), text. A missing or empty text fails the query.
    """
    present = F.coalesce(F.col("text"), F.lit("")) != ""
    text = F.when(present, F.col("text")).otherwise(
        F.raise_error(F.concat(F.lit("missing evaluation result: "), F.col("variant")))
    )
    return results.select("variant", F.from_json(text, schemas.EVAL_RESULT, {"mode": "FAILFAST"}).alias("result"))


def result_metrics(parsed: DataFrame) -> DataFrame:
    """(variant, metric, value) of parsed results, ready for comparison."""
    r = "result"
    values: dict[str, Column] = {
        "recall": F.col(f"{r}.detection.recall.mean"),
        "precision": F.col(f"{r}.detection.precision.mean"),
        "f2": F.col(f"{r}.detection.f2.mean"),
        "recall_stddev": F.col(f"{r}.detection.recall.stddev"),
        "category_accuracy": F.col(f"{r}.categorization.accuracy.mean"),
        "score_in_range": F.col(f"{r}.urgency_scoring.in_range_rate.mean"),
        "scam_detection": F.col(f"{r}.scam_detection.accuracy.mean"),
        "clean_parse_rate": F.col(f"{r}.json_health.clean_parse_rate.mean"),
        "corrective_retry_rate": F.col(f"{r}.json_health.corrective_retry_rate.mean"),
        "total_failures": F.col(f"{r}.json_health.total_failures"),
        "cost": F.col(f"{r}.cost.avg_cost_per_thread"),
    }
    entries = [
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in values.items()
    ]
    return parsed.select("variant", F.explode(F.array(*entries)).alias("e")).select("variant", "e.metric", "e.value")


def result_threads(parsed: DataFrame) -> DataFrame:
    """(variant, id, want_deal, counts): the per-thread part of parsed results."""
    return parsed.select("variant", F.explode("result.per_thread").alias("t")).select(
        "variant",
        "t.id",
        F.col("t.expected.is_deal").alias("want_deal"),
        "t.detection_correct",
        "t.category_correct",
        "t.score_in_range",
        "t.scam_correct",
        "t.total_runs",
    )


def result_categories(parsed: DataFrame) -> DataFrame:
    """(variant, category, accuracy_mean, ground_truth_count) of parsed results."""
    return parsed.select("variant", F.explode("result.categorization.per_category").alias("category", "c")).select(
        "variant", "category", F.col("c.mean").alias("accuracy_mean"), F.col("c.ground_truth_count").alias("ground_truth_count")
    )
