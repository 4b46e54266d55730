"""Reply repair, coercion, layers and thread texts."""

import json

import pytest
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.operators import outcomes, replies, threads


def parse(spark, *raws):
    frame = spark.createDataFrame([(str(i), raw) for i, raw in enumerate(raws)], "batch_id string, raw string")
    return replies.parse_replies(frame)


def item(spark, value):
    parsed = parse(spark, json.dumps([value]))
    return replies.reply_items(parsed).first()


@pytest.mark.parametrize(
    "raw, size, error",
    [
        ('[{"a": 1}]', 1, None),
        ('```json\n[{"a": 1}, {"a": 2}]\n```', 2, None),
        ('```\n[{"a": 1}]```  ', 1, None),
        ('Sure:\n[{"a": 1}]\nDone.', 1, None),
        ('{"results": [{"a": 1}]}', 1, None),
        ('{"n": 1, "results": []}', 0, None),
        ('{"a": [{"x": 1}], "b": [{"y": 2}]}', None, fixed.NO_SINGLE_ARRAY_ERROR),
        ('{"a": 1}', None, fixed.NOT_AN_ARRAY_ERROR),
        ("17", None, fixed.NOT_AN_ARRAY_ERROR),
        ("sorry", None, fixed.NO_JSON_ERROR),
        ("", None, fixed.NO_JSON_ERROR),
        (None, None, fixed.NO_JSON_ERROR),
        ('[{"a": 1}, null]', None, fixed.NOT_AN_ARRAY_ERROR),
        ('[{"a": 1}', None, fixed.NO_SINGLE_ARRAY_ERROR),
    ],
)
def test_repair(spark, raw, size, error):
    row = parse(spark, raw).select(F.size("items").alias("n"), F.col("items").isNull().alias("none"), "parse_error").first()
    assert row.parse_error == error
    assert row.none if size is None else row.n == size


@pytest.mark.parametrize(
    "given, score",
    [(7, 7), ("8", 8), (" 6 ", 6), (2.5, 3), (0, 5), (None, 5), ("abc", 5), (99, 10), (-4, 1), (True, 1), ("", 5), ([], 5), ("7d", 5)],
)
def test_scores(spark, given, score):
    assert item(spark, {"is_deal": True, "ai_score": given}).ai_score == score


@pytest.mark.parametrize(
    "given, deal",
    [(True, True), (False, False), ("false", True), ("", False), (0, False), (2, True), (None, False), ([], True), ({}, True)],
)
def test_truthiness(spark, given, deal):
    assert item(spark, {"is_deal": given}).is_deal is deal


def test_fields_of_a_deal(spark):
    r = item(spark, {
        "thread_id": 12, "is_deal": True, "is_english": False, "language": "de", "category": "odd", "deal_type": "x",
        "likely_scam": 0, "ai_summary": "s" * 1200, "main_contact": {"name": "Ann", "email": "", "phone_number": 5},
        "deal_value": "12.5", "deal_currency": "EUR", "deal_name": "D",
    })
    assert (r.thread_id, r.is_english, r.language, r.category, r.deal_type) == ("12", False, "de", "low_confidence", "other_business")
    assert len(r.ai_summary) == 1000 and r.likely_scam is False and r.deal_value == 12.5
    assert (r.main_contact.name, r.main_contact.email, r.main_contact.phone_number) == ("Ann", None, "5")


def test_fields_of_no_deal(spark):
    r = item(spark, {"category": "likely_scam", "main_contact": {"name": "A"}, "deal_brand": "B", "deal_name": "D", "deal_currency": "USD"})
    assert r.likely_scam is True and r.is_english is True and r.ai_insight == ""
    assert (r.category, r.main_contact, r.deal_brand, r.deal_name, r.deal_type, r.deal_value) == (None,) * 6
    assert r.deal_currency == "USD"


def test_thread_ids_follow_the_batch_order(spark):
    raw = json.dumps([
        {"thread_index": 2}, {"thread_index": 0}, {"thread_index": -3}, {"thread_index": "1"},
        {"thread_index": 9, "thread_id": "own"}, {"thread_index": 9}, {"thread_id": "free"}, {"thread_index": None, "thread_id": "n"},
        {"thread_index": "abc", "thread_id": "unread"}, {"thread_index": 1.5, "thread_id": "half"}, {"thread_index": "", "thread_id": "blank"},
    ])
    order = spark.createDataFrame([("0", 1, "first"), ("0", 2, "second")], "batch_id string, thread_index int, thread_id string")
    rows = replies.reply_items(parse(spark, raw), order).orderBy("pos").collect()
    assert [r.thread_id for r in rows] == ["second", "first", "first", "first", "own", "", "free", "n", "unread", "half", "first"]


def test_layers(spark):
    good, bad = '[{"is_deal": true}]', "no"
    rows = [
        ("cached", "cached", "m", good), ("cached", "primary", "m", good),
        ("fixed", "primary", "m", bad), ("fixed", "corrective", "m", good), ("fixed", "fallback", "f", good),
        ("second", "primary", "m", bad), ("second", "fallback", "f", good),
        ("lost", "primary", "m", bad), ("lost", "fallback", "f", bad),
    ]
    frame = spark.createDataFrame(rows, "batch_id string, layer string, model string, raw string")
    best = {r.batch_id: (r.layer, r.model_used) for r in replies.first_usable_reply(replies.parse_replies(frame)).collect()}
    assert best == {
        "cached": ("cached", "m"), "fixed": ("corrective", "m(corrective-retry)"), "second": ("fallback", "f"), "lost": (None, None),
    }


def test_contradicting_items_are_no_deal(spark):
    frame = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("", True)], "thread_id string, is_deal boolean")
    assert {r.thread_id: r.is_deal for r in outcomes.thread_verdicts(frame).collect()} == {"a": False, "b": True}


def messages(spark, rows):
    return spark.createDataFrame(
        rows,
        "thread_id string, message_id string, position bigint, headers array<struct<name:string,value:string>>, "
        "body string, reply_body string, previous_ai_summary string",
    )


def test_batch_text_format(spark):
    head = [("From", "a@x.co"), ("Date", "today"), ("Subject", "Hi $& {{x}}")]
    frame = messages(spark, [
        ("t1", "m2", 2, head, "", "second", None),
        ("t1", "m1", 1, head, "first", None, "old"),
        ("t2", "m3", 1, [], None, None, None),
    ])
    batches = spark.createDataFrame([("b", "t1", 1), ("b", "t2", 2)], "batch_id string, thread_id string, thread_index int")
    want = (
        "THREAD_ID_INDEX: 1\nMODE: FULL_THREAD\nMessage Count: 2\nPREVIOUS_AI_SUMMARY: old\n\n"
        "[Message 1]\nFrom: a@x.co\nDate: today\nSubject: Hi $& {{x}}\n\nfirst\n\n"
        "[Message 2]\nFrom: a@x.co\nDate: today\nSubject: Hi $& {{x}}\n\nsecond\n\n===\n\n"
        "THREAD_ID_INDEX: 2\nMODE: FULL_THREAD\nMessage Count: 1\nPREVIOUS_AI_SUMMARY: None\n\n"
        "[Message 1]\nFrom: \nDate: \nSubject: \n\n[no body]\n\n===\n"
    )
    segments = threads.batch_segments(frame, batches)
    assert threads.batch_texts(segments).first().thread_data == want
    parts = threads.batch_texts(segments, messages_per_part=1).orderBy("part_no").collect()
    assert len(parts) == 3 and "".join(p.thread_data for p in parts) == want
    assert sum(p.threads for p in parts) == 2
    for size in (1, 2, 500):
        texts = threads.batch_texts(segments, size).withColumn("creator_email", F.lit("c@x.co"))
        prompts = threads.user_prompts(texts, F.lit(" Go:\n{{THREAD_DATA}}\n")).orderBy("part_no").collect()
        assert "".join(p.user_prompt for p in prompts) == "Go:\nCreator email: c@x.co\n\n" + want.rstrip()


def test_audit_json_stays_readable(spark, as_of):
    parsed = parse(spark, json.dumps([{"is_deal": True, "deal_name": "The “big” ‘one’"}]))
    items = replies.reply_items(parsed)
    counts = spark.createDataFrame([("0", 3)], "batch_id string, email_count bigint")
    labels = spark.createDataFrame([("0", "m")], "batch_id string, model_used string")
    audit = outcomes.audit_rows(labels, items, counts, as_of).first()
    stored = json.loads(audit.ai_evaluation)
    assert stored["threads"][0]["deal_name"] == "The \"big\" 'one'"
    assert (audit.thread_count, audit.email_count, audit.inference_cost) == (1, 3, 0.0)
    cached = replies.cached_threads(spark.createDataFrame([("0", audit.ai_evaluation), ("1", "{bad")], "batch_id string, ai_evaluation string"))
    assert {r.batch_id: r["items"] is None for r in cached.collect()} == {"0": False, "1": True}


def test_parts_are_bounded_in_bytes(spark):
    """500 long messages: every part stays below the bound and the parts are the whole text."""
    rows = [("b", i + 1, i == 0, "é" * 900 + f" {i}\n") for i in range(500)] + [("c", 1, True, "x"), ("c", 2, False, "y" * 50_000), ("c", 3, False, "z"), (None, 1, True, "n")]
    segments = spark.createDataFrame(rows, "batch_id string, segment_no bigint, opens_thread boolean, segment string").repartition(5)
    parts = threads.batch_texts(segments, part_bytes=20_000).orderBy("batch_id", "part_no").collect()
    of_b = [p for p in parts if p.batch_id == "b"]
    assert len(of_b) > 20 and all(len(p.thread_data.encode()) <= 20_000 for p in of_b)
    assert "".join(p.thread_data for p in of_b) == "".join(r[3] for r in rows[:500])
    assert sum(p.emails for p in of_b) == 500 and sum(p.threads for p in of_b) == 1
    assert "".join(p.thread_data for p in parts if p.batch_id == "c") == "x" + "y" * 50_000 + "z"
    assert [p.thread_data for p in parts if p.batch_id is None] == ["n"]


def test_messages_by_thread_in_bytes(spark):
    rows = [("t", f"m{i:03d}", i, "a" * (i % 7 * 100)) for i in range(200)]
    frame = spark.createDataFrame(rows, "thread_id string, message_id string, position bigint, body string")
    parts = threads.messages_by_thread(frame, part_bytes=3000).orderBy("part_no").collect()
    assert [m.message_id for p in parts for m in p.messages] == [r[1] for r in rows]
    assert len(parts) > 10 and all(sum(len(m.message_id) + len(m.body) for m in p.messages) <= 3000 for p in parts)
