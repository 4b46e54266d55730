"""Metrics, comparison, eligibility, notifications, look-back windows."""

import json

import pytest
from pyspark.sql import functions as F

from threadsift.operators import compare, eligibility, lookback, metrics, notifications
from threadsift.sources import documents

TRUTH = "id string, is_deal boolean, category string, likely_scam boolean, score_lo int, score_hi int"
PREDICTIONS = "run_id int, thread_id string, pos int, is_deal boolean, category string, likely_scam boolean, ai_score int"


@pytest.fixture()
def truth(spark):
    return spark.createDataFrame([
        ("d1", True, "new", False, 5, 8), ("d2", True, "in_progress", False, 5, 8), ("d3", True, "likely_scam", True, 1, 3),
        ("n1", False, None, False, 1, 2), ("n2", False, None, False, None, None),
    ], TRUTH)


def runs(spark, *lists):
    rows = [(run, thread, pos, *rest) for run, answers in enumerate(lists, 1) for pos, (thread, *rest) in enumerate(answers)]
    return spark.createDataFrame(rows, PREDICTIONS)


PERFECT = [
    ("d1", True, "new", False, 6), ("d2", True, "in_progress", False, 5), ("d3", True, "likely_scam", True, 1),
    ("n1", False, None, False, 1), ("n2", False, None, False, 9),
]


def test_perfect_runs(spark, truth):
    predictions = runs(spark, PERFECT, PERFECT)
    row = metrics.detection(truth, predictions).first()
    assert (row.recall_mean, row.precision_mean, row.f2_mean, row.recall_stddev) == (1, 1, 1, 0)
    assert metrics.category_accuracy(truth, predictions).first().accuracy_mean == 1
    assert metrics.score_in_range(truth, predictions).first().in_range_rate_mean == 1
    assert tuple(metrics.scam_detection(truth, predictions).first())[0::4] == (1.0, 1)


def test_missing_and_false_answers(spark, truth):
    predictions = runs(spark, [("d1", True, "completed", False, 9), ("d2", True, "in_progress", False, 5), ("n1", True, "new", False, 1)])
    row = metrics.detection(truth, predictions).first()
    assert (row.recall_mean, row.precision_mean) == (0.6667, 0.6667)
    assert metrics.category_accuracy(truth, predictions).first().accuracy_mean == 0.5
    assert metrics.score_in_range(truth, predictions).first().in_range_rate_mean == 0.6667
    assert metrics.scam_detection(truth, predictions).first().accuracy_mean == 0
    by_category = {r.category: r.accuracy_mean for r in metrics.accuracy_per_category(truth, predictions).collect()}
    assert by_category == {"new": 0.0, "in_progress": 1.0, "likely_scam": 1.0}


def test_spread_is_population_stddev(spark, truth):
    none = [("n1", False, None, False, 1)]
    row = metrics.detection(truth, runs(spark, PERFECT, none)).first()
    assert (row.recall_mean, row.recall_min, row.recall_max, row.recall_stddev) == (0.5, 0, 1, 0.5)
    assert (row.precision_min, row.f2_min) == (1.0, 0.0)


def test_last_answer_scores_but_first_answer_counts_per_thread(spark, truth):
    predictions = runs(spark, [("d1", False, None, False, 1), ("d1", True, "new", False, 6)])
    assert metrics.detection_by_run(truth, predictions).first().tp == 1
    row = {r.id: r for r in metrics.per_thread(truth, predictions).collect()}["d1"]
    assert (row.detection_correct, row.category_correct, row.score_in_range, row.scam_correct, row.total_runs) == (0, 0, 0, 1, 1)


def test_no_predictions_give_zeros(spark, truth):
    empty = spark.createDataFrame([], PREDICTIONS)
    assert set(metrics.detection(truth, empty).first()) == {0.0}
    with pytest.raises(Exception, match="All runs failed"):
        health = spark.createDataFrame([(False, False, False, True)], "clean boolean, repaired boolean, corrective_retry boolean, failed boolean")
        usage = spark.createDataFrame([(1, 1)], "input_tokens bigint, output_tokens bigint")
        metrics.report(truth, empty, health, usage).collect()


def test_json_health_and_cost(spark, truth):
    health = spark.createDataFrame([(True, False, False, False), (False, False, True, True)], "clean boolean, repaired boolean, corrective_retry boolean, failed boolean")
    row = metrics.json_health(health).first()
    assert (row.clean_parse_rate_mean, row.repaired_rate_mean, row.corrective_retry_rate_mean, row.total_failures) == (0.5, 0, 0.5, 1)
    usage = spark.createDataFrame([(1000, 500), (2000, 500)], "input_tokens bigint, output_tokens bigint")
    assert tuple(metrics.cost(usage, truth).first()) == (3000, 1000, 0.001)


def saved_result(recall, detection_correct, category=1.0):
    flat = {"mean": recall, "min": recall, "max": recall, "stddev": 0.0}
    one = {"mean": 1.0, "min": 1.0, "max": 1.0, "stddev": 0.0}
    return json.dumps({
        "model": "m", "runs": 2, "successful_runs": 2,
        "detection": {"recall": flat, "precision": one, "f2": flat},
        "categorization": {"accuracy": {**one, "mean": category}, "per_category": {"new": {**one, "ground_truth_count": 3}}},
        "urgency_scoring": {"in_range_rate": one}, "scam_detection": {"accuracy": one, "total_scam_threads": 1},
        "json_health": {"clean_parse_rate": one, "repaired_rate": one, "corrective_retry_rate": one, "total_failures": 0},
        "cost": {"total_input_tokens": 1, "total_output_tokens": 1, "avg_cost_per_thread": 0.01},
        "per_thread": [{"id": "d1", "expected": {"is_deal": True}, "detection_correct": detection_correct,
                        "category_correct": 2, "score_in_range": 2, "scam_correct": 2, "total_runs": 2}],
    })


def compare_saved(spark, a, b):
    frame = spark.createDataFrame([("a", a), ("b", b)], "variant string, text string")
    parsed = documents.parse_results(frame)

    def side(rows, name):
        return rows.filter(F.col("variant") == name).drop("variant")

    values, per_thread = documents.result_metrics(parsed), documents.result_threads(parsed)
    table = compare.compare_metrics(side(values, "a"), side(values, "b"))
    worse = compare.regressions(side(per_thread, "a"), side(per_thread, "b"))
    return table, worse, compare.verdict(table, worse), documents.result_categories(parsed)


def test_saved_results_pass(spark):
    table, worse, verdict, categories = compare_saved(spark, saved_result(0.96, 2), saved_result(0.97, 2))
    recall = {r.metric: r for r in table.collect()}["recall"]
    assert (recall.delta, recall.winner) == (0.01, "b")
    assert worse.count() == 0 and verdict.first().verdict == "PASS"
    assert categories.count() == 2


def test_saved_results_fail_on_regressions(spark):
    _, worse, verdict, _ = compare_saved(spark, saved_result(0.96, 2), saved_result(0.96, 1))
    assert [tuple(r) for r in worse.collect()] == [("d1", "missed_deal")]
    row = verdict.first()
    assert (row.verdict, row.no_new_missed_deals, row.b_recall_above_95) == ("FAIL", False, True)


def test_missing_result_is_an_error(spark):
    with pytest.raises(Exception, match="missing evaluation result"):
        frame = spark.createDataFrame([("a", saved_result(1, 1)), ("b", "")], "variant string, text string")
        documents.parse_results(frame).collect()


def test_truth_and_rule_list_files(spark, tmp_path):
    truth = [{"id": "x", "description": "d", "emails": [{"messageId": "m", "body": "hi", "topLevelHeaders": [{"name": "From", "value": "a@x.co"}]}],
              "expected": {"is_deal": True, "category": "new", "score_range": [2, 4]}}]
    (tmp_path / "truth.json").write_text(json.dumps(truth))
    row = documents.labels_of(documents.read_truth(spark, str(tmp_path / "truth.json"))).first()
    assert tuple(row) == ("x", True, "new", False, 2, 4)
    (tmp_path / "lists.json").write_text(json.dumps({"mailing_tools": ["toolbox"]}))
    lists = documents.read_rule_lists(spark, str(tmp_path / "lists.json"))
    assert lists.mailing_tools == ("toolbox",) and len(lists.blocked_prefixes) == 38


@pytest.mark.parametrize(
    "integer, double, sent",
    [("1710000000", None, True), (" 5 ", None, True), ("0", None, False), ("-1", None, False), ("text", 5.0, False), ("", 1.5, True),
     (None, -1.5, False), (None, float("nan"), False), (None, float("inf"), False), (None, None, False)],
)
def test_markers(spark, integer, double, sent):
    frame = spark.createDataFrame([(integer, double)], "i string, d double")
    assert frame.select(notifications.is_sent(F.col("i"), F.col("d")).alias("s")).first().s is sent


def test_payload(spark):
    columns = "USER_ID DB_NEW DB_IN_PROGRESS DB_COMPLETED DB_NOT_INTERESTED DB_LIKELY_SCAM DB_LOW_CONFIDENCE CONTACTS_ADDED".split()
    rows = spark.createDataFrame([("u1", "3", "x", None, "1", "2", "0", "4"), (" ", "1", "1", "1", "1", "1", "1", "1"), ("u2", *"1111111")], ", ".join(f"{c} string" for c in columns))
    markers = spark.createDataFrame([("u2", "9", None)], "user_id string, integer_value string, double_value double")
    sent = notifications.outbox(rows, markers).collect()
    assert [r.user_id for r in sent] == ["u1"]
    assert json.loads(sent[0].payload) == {
        "userId": "u1", "eventType": "scan_complete",
        "eventData": {"dealCounts": {"new": 3, "inProgress": 0, "completed": 0, "likelyScam": 2, "lowConfidence": 0, "notInterested": 1}, "contactsAdded": 4},
    }
    assert tuple(notifications.summary(rows, markers).first()) == (3, 1, 1, 1)


@pytest.mark.parametrize("limit", [0, -1, 1.5, True])
def test_report_limit_is_checked(spark, limit):
    with pytest.raises(ValueError):
        eligibility.eligible_report(*[None] * 7, limit=limit)


@pytest.mark.parametrize(
    "text, days",
    [(None, 60), ("", 60), ("  45 ", 45), ("60", 60), ("60days", 60), ("abc", 60), ("3651", 3650), ("0", 60), ("-5", 60), ("1.5", 60),
     ("9007199254740993", 60), ("99999999999999999999999", 60)],
)
def test_lookback_days(spark, text, days):
    frame = spark.createDataFrame([(text,)], "x string")
    assert frame.select(lookback.lookback_days(F.col("x")).alias("d")).first().d == days


def test_lookback_range_is_in_hours(spark):
    frame = spark.createDataFrame([("2024-03-31 12:00:00", 60)], "e string, d int").select(
        lookback.range_start(F.col("e").cast("timestamp"), F.col("d")).cast("string").alias("s")
    )
    assert frame.first().s == "2024-01-31 12:00:00"


@pytest.mark.parametrize(
    "days, done, quota, rate, batch, elapsed, budget, reason",
    [
        (60, False, True, True, True, 9, 1, "gmail_quota"), (60, None, False, True, True, 9, 1, "gmail_rate_limit"),
        (60, False, None, None, True, 9, 1, "batch_processing_constraint"), (60, False, False, False, False, 5, 5, "operational_window_exceeded"),
        (60, False, False, False, False, 4, 5, None), (60, False, False, False, False, 4, 0, None), (60, False, False, False, False, None, 5, None),
        (60, True, True, True, True, 9, 1, None), (45, False, True, True, True, 9, 1, None),
    ],
)
def test_fallback_reasons(spark, days, done, quota, rate, batch, elapsed, budget, reason):
    frame = spark.createDataFrame(
        [("u", days, done, quota, rate, batch, elapsed, budget)],
        "user_id string, days_requested int, sync_complete boolean, quota boolean, rate_limited boolean, batch_blocked boolean, elapsed_ms bigint, budget_ms bigint",
    )
    found = lookback.fallback_reason(frame)
    assert found.first().reason == reason
    lines = [json.loads(r.line) for r in lookback.fallback_log(found).collect()]
    assert lines == ([] if reason is None else [{"event": "uei_lookback_fallback", "userId": "u", "fellBackTo": 45, "reason": reason}])


def test_unknown_reason_fails(spark):
    frame = spark.createDataFrame([("u", "bored")], "user_id string, reason string")
    with pytest.raises(Exception, match="Invalid look-back"):
        lookback.fallback_log(frame).collect()


def test_saved_results_keep_all_metrics(spark, sf_dir):
    from threadsift import registry

    registry.load_all()
    rows = {r.metric: r for r in registry.QUERIES["src_5b_all_saved_results"](spark, sf_dir).collect()}
    assert len(rows) == 11
    assert all(rows[m].a is not None for m in ("clean_parse_rate", "corrective_retry_rate", "total_failures", "cost"))


def test_results_are_saved_with_their_threads(spark, truth, tmp_path):
    """Report and per-thread table are one version; half a version is not read."""
    predictions = spark.createDataFrame(
        [(1, "d1", 1, True, "new", False, 3), (2, "d1", 1, True, "completed", False, 9), (2, "d2", 1, False, None, False, 1)],
        "run_id bigint, thread_id string, pos int, is_deal boolean, category string, likely_scam boolean, ai_score int",
    )
    health = spark.createDataFrame([(True, False, False, False)], "clean boolean, repaired boolean, corrective_retry boolean, failed boolean")
    usage = spark.createDataFrame([(100, 10)], "input_tokens bigint, output_tokens bigint")
    report = metrics.report(truth, predictions, health, usage, {"model": "m"})
    threads = metrics.per_thread(truth, predictions)
    assert documents.save_result(report, threads, str(tmp_path), "a") == 1
    # A job that dies between the two parts leaves a version that nobody reads.
    threads.limit(0).write.parquet(str(tmp_path / "a" / "threads" / "v=2"))
    result, stored = documents.read_result(spark, str(tmp_path), "a")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, threads.collect()))
    direct = {r.category: r.accuracy_mean for r in metrics.accuracy_per_category(truth, predictions).collect()}
    assert {r.category: r.accuracy_mean for r in documents.result_categories(result).collect()} == direct
    values = {r.metric: r.value for r in documents.result_metrics(result).collect()}
    assert len(values) == 11 and values["recall"] == metrics.detection(truth, predictions).first().recall_mean
    assert documents.save_result(report, threads, str(tmp_path), "a") == 3
    with pytest.raises(FileNotFoundError):
        documents.read_result(spark, str(tmp_path), "b")


def test_answers_and_misses_without_listing_them(spark, truth):
    predictions = spark.createDataFrame(
        [(1, "d1", 1, True, "new", False, 3), (1, "d1", 2, False, None, False, 1), (2, "elsewhere", 1, True, "new", False, 3)],
        "run_id bigint, thread_id string, pos int, is_deal boolean, category string, likely_scam boolean, ai_score int",
    )
    total = truth.count()
    found = {r.run_id: (r.answered, r.unanswered) for r in metrics.unanswered_counts(truth, predictions).collect()}
    assert found == {1: (1, total - 1), 2: (0, total)}
    listed = metrics.expected_and_answered(truth, predictions)
    assert listed.count() == 2 * total and listed.filter("NOT is_missing").count() == 1
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Generate", "NestedLoop", "CartesianProduct", "collect_set"))
    assert metrics.expected_and_answered(truth, predictions.limit(0)).count() == 0


def test_replies_are_parsed_once_for_both_saved_variants(spark, sf_dir, monkeypatch):
    """Every value of both reports comes from one written table of the replies' health."""
    from threadsift import registry

    registry.load_all()
    from threadsift.registry import documents as queries
    from threadsift.registry.inputs import Inputs

    asked = []
    health = queries.health
    monkeypatch.setattr(queries, "health", lambda t: asked.append(1) or health(t))
    for name in (queries.saved_variants, queries.saved_results):
        asked.clear()
        name(Inputs(spark, sf_dir))
        assert len(asked) == 1
