"""Quality of model runs against labelled threads.

`truth`: id, is_deal, category, likely_scam, score_lo, score_hi.
`predictions`: run_id, thread_id, pos, is_deal, category, likely_scam, ai_score, where
`pos` orders repeated answers of a run about one thread.
A run is the set of its prediction rows; a run without any is not scored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed

ANSWER_FIELDS = ("is_deal", "category", "likely_scam", "ai_score")


def stats(values: Column, prefix: str) -> list[Column]:
    """mean, min, max and population standard deviation to 4 digits; 0 without values."""
    forms = {"mean": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_pop}
    return [
        F.coalesce(F.round(form(values), 4), F.lit(0.0)).alias(f"{prefix}_{name}") for name, form in forms.items()
    ]


def ratio(part: Column, whole: Column, empty: float = 1.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))


def answers(predictions: DataFrame, keep: str = "last") -> DataFrame:
    """One answer per run and thread: the last one, or the first one for per-thread counts."""
    pick = F.max_by if keep == "last" else F.min_by
    chosen = predictions.groupBy("run_id", "thread_id").agg(
        pick(F.struct(*ANSWER_FIELDS), F.col("pos")).alias("answer")
    )
    return chosen.select("run_id", "thread_id", *[F.col(f"answer.{name}").alias(name) for name in ANSWER_FIELDS])


def judged(truth: DataFrame, predictions: DataFrame, keep: str = "last") -> DataFrame:
    """Every answer beside its expectation; answers about unlabelled threads keep NULL expectations."""
    expected = truth.select(
        F.col("id").alias("thread_id"),
        F.col("is_deal").alias("want_deal"),
        F.col("category").alias("want_category"),
        F.col("likely_scam").alias("want_scam"),
        "score_lo",
        "score_hi",
    )
    return answers(predictions, keep).join(expected, "thread_id", "left")


#: A quality check has tens of runs; beyond this the full listing is refused.
MOST_RUNS = 1000


def answered_threads(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """The labelled threads a run has answered, one row for each run and thread."""
    expected = truth.select(F.col("id").alias("thread_id"), F.col("is_deal").alias("want_deal"))
    return answers(predictions).join(expected, "thread_id")


def unanswered_counts(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per run, how many labelled threads and how many labelled deals it left unanswered.

    What a run did not answer is counted from totals and never listed.
    """
    totals = truth.agg(F.struct(F.count(F.lit(1)).alias("threads"), F.count_if("is_deal").alias("deals")).alias("n")).scalar()
    found = answered_threads(truth, predictions).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("answered"), F.count_if("want_deal").alias("answered_deals")
    )
    every = predictions.select("run_id").distinct().join(found, "run_id", "left").na.fill(0, ["answered", "answered_deals"])
    return every.select(
        "run_id",
        "answered",
        (totals["threads"] - F.col("answered")).alias("unanswered"),
        (totals["deals"] - F.col("answered_deals")).alias("unanswered_deals"),
    )


def expected_and_answered(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each labelled thread in each run, answered or not: the full listing, on request.

    It has a row for each thread and run. The scores need only `answered_threads` and
    `unanswered_counts`.
    """
    names = [r.run_id for r in predictions.select("run_id").distinct().limit(MOST_RUNS + 1).collect()]
    if len(names) > MOST_RUNS:
        raise ValueError(f"more than {MOST_RUNS} runs cannot be listed in full")
    kind = predictions.schema["run_id"].dataType
    expected = truth.select(F.col("id").alias("thread_id"), F.col("is_deal").alias("want_deal"))
    listed = [expected.withColumn("run_id", F.lit(name).cast(kind)) for name in names] or [expected.limit(0).withColumn("run_id", F.lit(None).cast(kind))]
    every = reduce(DataFrame.unionByName, listed)
    return every.join(answers(predictions), ["run_id", "thread_id"], "left").withColumn(
        "is_missing", F.col("is_deal").isNull()
    )


def _labelled_category() -> Column:
    return F.col("want_deal") & (F.coalesce("want_category", F.lit("")) != "")


def run_scores(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """All counts and scores of each run from one pass over the answers.

    An expected deal or scam without an answer is missed, so the misses follow from the
    totals and no run has to be expanded to all labelled threads.
    """
    totals = truth.agg(
        F.struct(F.count_if("is_deal").alias("deals"), F.count_if("likely_scam").alias("scams")).alias("n")
    ).scalar()
    found = _labelled_category() & F.col("is_deal")
    has_range = F.col("score_lo").isNotNull() & F.col("score_hi").isNotNull()
    counts = judged(truth, predictions).groupBy("run_id").agg(
        F.count_if(F.col("want_deal") & F.col("is_deal")).alias("tp"),
        F.count_if(~F.col("want_deal") & F.col("is_deal")).alias("fp"),
        F.count_if(found).alias("found"),
        F.count_if(found & (F.col("category") == F.col("want_category"))).alias("right"),
        F.count_if(has_range).alias("ranged"),
        F.count_if(has_range & F.col("ai_score").between(F.col("score_lo"), F.col("score_hi"))).alias("inside"),
        F.count_if(F.col("want_scam") & F.col("likely_scam")).alias("caught"),
    )
    recall, precision = F.col("recall"), F.col("precision")
    return (
        counts.withColumns({"fn": totals["deals"] - F.col("tp"), "scams": totals["scams"]})
        .withColumns(
            {
                "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
                "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                "accuracy": ratio(F.col("right"), F.col("found")),
                "in_range_rate": ratio(F.col("inside"), F.col("ranged")),
                "scam_accuracy": ratio(F.col("caught"), F.col("scams")),
            }
        )
        .withColumn(
            "f2", F.when(precision + recall > 0, 5 * precision * recall / (4 * precision + recall)).otherwise(0.0)
        )
    )


def detection_by_run(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """recall, precision and F2 per run."""
    return run_scores(truth, predictions).select("run_id", "tp", "fp", "fn", "recall", "precision", "f2")


def detection(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    runs = run_scores(truth, predictions)
    return runs.agg(*[c for name in ("recall", "precision", "f2") for c in stats(F.col(name), name)])


def category_accuracy(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Of the deals found, the share with the right category; 1 for a run that found none."""
    return run_scores(truth, predictions).agg(*stats(F.col("accuracy"), "accuracy"))


def accuracy_per_category(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """The same per expected category, with the number of labelled threads in it.

    Runs that found no deal of a category count as 1 for it; they add nothing but
    ones, so they are added by number instead of by row.
    """
    sizes = (
        truth.filter(F.col("is_deal") & (F.coalesce("category", F.lit("")) != ""))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("ground_truth_count"))
    )
    by_run = (
        judged(truth, predictions)
        .filter(_labelled_category() & F.col("is_deal"))
        .groupBy("run_id", F.col("want_category").alias("label"))
        .agg((F.count_if(F.col("category") == F.col("want_category")) / F.count(F.lit(1))).alias("share"))
    )
    runs = predictions.agg(F.sort_array(F.collect_set("run_id")).alias("runs")).scalar()
    every = sizes.select(F.col("category").alias("label"), "ground_truth_count", F.explode(runs).alias("run_id"))
    shares = every.join(by_run, ["run_id", "label"], "left")
    return (
        shares.groupBy(F.col("label").alias("category"), "ground_truth_count")
        .agg(*stats(F.coalesce("share", F.lit(1.0)), "accuracy"))
    )


def score_in_range(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Share of answers inside the expected range, of threads that have one."""
    return run_scores(truth, predictions).agg(*stats(F.col("in_range_rate"), "in_range_rate"))


def scam_detection(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Share of expected scams flagged; a missing answer is not flagged."""
    return run_scores(truth, predictions).agg(
        *stats(F.col("scam_accuracy"), "accuracy"),
        F.coalesce(F.max("scams"), F.lit(0)).alias("total_scam_threads"),
    )


def headline(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """All headline statistics as four structs in one row."""
    runs = run_scores(truth, predictions)
    return runs.agg(
        F.struct(*[c for name in ("recall", "precision", "f2") for c in stats(F.col(name), name)]).alias("detection"),
        F.struct(*stats(F.col("accuracy"), "accuracy")).alias("categorization"),
        F.struct(*stats(F.col("in_range_rate"), "in_range_rate")).alias("urgency_scoring"),
        F.struct(
            *stats(F.col("scam_accuracy"), "accuracy"),
            F.coalesce(F.max("scams"), F.lit(0)).alias("total_scam_threads"),
        ).alias("scam_detection"),
        F.count(F.lit(1)).alias("successful_runs"),
    )


def per_thread(truth: DataFrame, predictions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """In how many runs each labelled thread was right; a run's first answer counts.

    `keep`: further columns of the labels that travel along.
    """
    runs = predictions.agg(F.count_distinct("run_id").alias("n")).scalar()
    inside = F.col("ai_score").between(F.col("score_lo"), F.col("score_hi"))
    right_category = F.col("want_deal") & F.col("is_deal") & (F.col("category") == F.col("want_category"))
    counts = judged(truth, predictions, keep="first").groupBy("thread_id").agg(
        F.count_if(F.col("is_deal") == F.col("want_deal")).alias("detection_correct"),
        F.count_if(right_category).alias("category_correct"),
        F.count_if(inside).alias("score_in_range"),
        F.count_if(F.col("likely_scam") == F.col("want_scam")).alias("scam_correct"),
    )
    names = ["detection_correct", "category_correct", "score_in_range", "scam_correct"]
    return (
        truth.select(F.col("id").alias("thread_id"), F.col("is_deal").alias("want_deal"), *keep)
        .join(counts, "thread_id", "left")
        .na.fill(0, names)
        .withColumn("total_runs", runs)
        .withColumnRenamed("thread_id", "id")
    )


def json_health(health: DataFrame) -> DataFrame:
    def rate(name: str) -> Column:
        return F.col(name).cast("int").cast("double")

    return health.agg(
        *stats(rate("clean"), "clean_parse_rate"),
        *stats(rate("repaired"), "repaired_rate"),
        *stats(rate("corrective_retry"), "corrective_retry_rate"),
        F.count_if("failed").alias("total_failures"),
    )


def cost(usage: DataFrame, truth: DataFrame) -> DataFrame:
    """Token totals over all runs and their cost per labelled thread.

    `usage`: input_tokens, output_tokens per call.
    """
    threads = truth.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = usage.agg(
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("total_input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("total_output_tokens"),
    )
    spent = (
        F.col("total_input_tokens") * F.lit(fixed.INPUT_TOKEN_COST)
        + F.col("total_output_tokens") * F.lit(fixed.OUTPUT_TOKEN_COST)
    )
    return totals.withColumn("_threads", threads).select(
        "total_input_tokens",
        "total_output_tokens",
        F.when(F.col("_threads") > 0, F.round(spent / F.col("_threads"), 6)).otherwise(0.0).alias("avg_cost_per_thread"),
    )


def report(
    truth: DataFrame,
    predictions: DataFrame,
    health: DataFrame,
    usage: DataFrame,
    settings: dict[str, object] | None = None,
) -> DataFrame:
    """The one-row evaluation report as nested structs.

    Raises inside the query when no run produced a single thread.
    """
    def part(frame: DataFrame) -> Column:
        return frame.select(F.struct(*frame.columns).alias("part")).scalar()

    categories = accuracy_per_category(truth, predictions)
    as_map = categories.agg(
        F.map_from_entries(
            F.collect_list(F.struct("category", F.struct(*[c for c in categories.columns if c != "category"])))
        ).alias("per_category")
    ).scalar()
    scored = headline(truth, predictions)
    runs = health.agg(F.count(F.lit(1)).alias("runs")).scalar()
    threads = truth.agg(F.count(F.lit(1)).alias("n")).scalar()
    named = [F.lit(value).alias(name) for name, value in (settings or {}).items()]
    return scored.select(
        *named,
        runs.alias("runs"),
        F.when(F.col("successful_runs") > 0, F.col("successful_runs"))
        .otherwise(F.raise_error(F.lit("All runs failed: no valid results to compute metrics")))
        .alias("successful_runs"),
        threads.alias("ground_truth_count"),
        "detection",
        "categorization",
        as_map.alias("per_category"),
        "urgency_scoring",
        "scam_detection",
        part(json_health(health)).alias("json_health"),
        part(cost(usage, truth)).alias("cost"),
    )
