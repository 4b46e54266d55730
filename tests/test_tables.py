"""Mutations, ranking helpers, snapshots and the state machine."""

import random

import pytest
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift import schemas
from threadsift.operators import mutations, ranking, states
from threadsift.plans import jobs
from threadsift.session import materialize
from threadsift.sources import lookups, partitioned, tables
from threadsift.streaming import sync

STATE_COLUMNS = "email_metadata_id string, user_id string, thread_id string, message_id string, sync_state_id string, status string, batch_id string, minutes_ago int"


def state_table(spark, rows):
    frame = spark.createDataFrame(rows, STATE_COLUMNS)
    stamp = F.lit("2024-01-20 00:00:00").cast("timestamp") - F.make_interval(mins=F.col("minutes_ago"))
    return schemas.conform(
        frame.withColumns({"id": F.col("email_metadata_id"), "created_at": stamp, "updated_at": stamp}), schemas.STATES
    )


def events(spark, rows):
    return schemas.conform(
        spark.createDataFrame(rows, "trigger_hash string, batch_id string, batch_type string, event_type string"),
        schemas.BATCH_EVENTS,
    )


def by_id(frame):
    return {r.email_metadata_id: (r.status, r.batch_id) for r in frame.collect()}


def test_upsert_keeps_and_overwrites(spark, as_of):
    target = spark.createDataFrame(
        [("u", "a@x", "Ann", "A", "2020-01-01"), ("u", "b@x", "Bo", "B", "2020-01-01")],
        "user_id string, email string, name string, company_name string, created_at string",
    ).withColumns({"created_at": F.col("created_at").cast("timestamp"), "updated_at": F.col("created_at").cast("timestamp")})
    source = spark.createDataFrame(
        [("u", "a@x", None, "New"), ("u", "c@x", "Cy", None)], "user_id string, email string, name string, company_name string"
    )
    once = mutations.upsert_table("contacts", target, source, as_of)
    got = {r.email: (r.name, r.company_name, str(r.created_at)[:4], str(r.updated_at)[:4]) for r in once.collect()}
    assert got == {
        "a@x": (None, "New", "2020", "2024"),
        "b@x": ("Bo", "B", "2020", "2020"),
        "c@x": ("Cy", None, "2024", "2024"),
    }
    twice = mutations.upsert_table("contacts", once, source, as_of)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_append_missing_ignores_known_keys(spark):
    old = spark.createDataFrame([("b1", "x")], "batch_id string, model string")
    new = spark.createDataFrame([("b1", "y"), ("b2", "y")], "batch_id string, model string")
    assert sorted(map(tuple, mutations.append_missing(old, new, "batch_id").collect())) == [("b1", "x"), ("b2", "y")]


def hot_rows(spark, n=3000, share=0.4):
    """One key holds a large part of all rows."""
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < share else f"k{rng.randrange(40)}", rng.randrange(500)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, key string, v bigint").repartition(6)


def test_numbered_is_the_exact_row_number(spark):
    rows, frame = hot_rows(spark)
    got = {r.id: r.row_no for r in ranking.numbered(frame, ["key"], F.floor(F.col("v") / 50), [F.col("v"), F.col("id")]).collect()}
    want = {}
    for key in {r[1] for r in rows}:
        for number, row in enumerate(sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])), 1):
            want[row[0]] = number
    assert got == want


def test_chunks_are_full_but_the_last(spark):
    rows, frame = hot_rows(spark)
    sizes = ranking.in_chunks(frame, ["key"], "id", 7).groupBy("key", "chunk_no").count().collect()
    for key in {r[1] for r in rows}:
        own = sorted((r.chunk_no, r["count"]) for r in sizes if r.key == key)
        assert [c for c, _ in own] == list(range(len(own)))
        assert all(n == 7 for _, n in own[:-1]) and 1 <= own[-1][1] <= 7


def test_first_n_per_key_is_exact(spark):
    rows, frame = hot_rows(spark)
    got = sorted(r.id for r in ranking.first_n_per_key(frame, ["key"], [F.col("v"), F.col("id")], 5, "id").collect())
    want = []
    for key in {r[1] for r in rows}:
        want += [r[0] for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))[:5]]
    assert got == sorted(want)


def test_latest_per_key(spark):
    rows, frame = hot_rows(spark)
    got = {r.key: r.id for r in ranking.latest_per_key(frame, ["key"], [F.col("v"), F.col("id")]).collect()}
    assert got == {key: max((r[2], r[0]) for r in rows if r[1] == key)[1] for key in {r[1] for r in rows}}


def test_complete_threads_and_null_syncs(spark, as_of):
    frame = state_table(spark, [
        ("e1", "u", "blocked", "m1", "s1", "pending_classification", None, 1),
        ("e2", "u", "blocked", "m2", "s1", "filtering", "b", 1),
        ("e3", "u", "other_sync", "m3", "s1", "pending_classification", None, 1),
        ("e4", "v", "other_sync", "m4", "s2", "pending", None, 1),
        ("e5", "u", "null_sync", "m5", None, "pending_classification", None, 1),
        ("e6", "u", "null_sync", "m6", None, "pending", None, 1),
    ])
    assert sorted(r.thread_id for r in states.complete_threads(frame).collect()) == ["null_sync", "other_sync"]
    claimed = by_id(states.claim_for_classification(frame, "c", as_of))
    assert {k for k, v in claimed.items() if v == ("classifying", "c")} == {"e3", "e5"}
    limited = by_id(states.claim_for_classification(frame, "c", as_of, limit=1))
    assert {k for k, v in limited.items() if v == ("classifying", "c")} == {"e5"}


def test_stuck_parents_are_split_and_others_renewed(spark, as_of):
    rows = [(f"e{i}", "u", f"t{i // 2}", f"m{i}", None, "classifying", "mega:1", 10) for i in range(10)]
    rows += [("x1", "u", "t9", "mx", None, "classifying", "plain", 10), ("x2", "u", "t9", "my", None, "deal", "plain", 10)]
    frame = state_table(spark, rows)
    after, new_events = states.retry_stuck(
        frame, events(spark, [("h1", "plain", "classify", "new")]), "classifying", "classify", as_of, split_size=2
    )
    got = after.collect()
    threads = {}
    for r in got:
        if r.email_metadata_id.startswith("e"):
            threads.setdefault(r.batch_id, set()).add(r.thread_id)
    assert sorted(len(t) for t in threads.values()) == [1, 2, 2]
    assert "mega:1" not in threads
    assert {str(r.updated_at) for r in got} == {"2024-01-20 00:00:00"}
    kinds = sorted((r.event_type, r.batch_id == "plain") for r in new_events.collect())
    assert kinds == [("new", False)] * 3 + [("retrigger", True)]


def test_renewed_filter_batches_are_filtered_again(spark, as_of):
    """A mail that comes after the first attempt, one that never comes, and a parent batch."""
    headers = "array<struct<name:string,value:string>>"
    mail = [("From", "Ann <ann@brand.com>")]
    bulk = [("From", "no-reply@brand.com")]
    rows = [(f"e{i}", "u", "t", f"m{i}", None, "pending", None, 10) for i in range(4)]
    rows += [(f"p{i}", "u", "t", f"m-p{i}", None, "filtering", "mega:1", 10) for i in range(5)]
    log = schemas.conform(spark.createDataFrame([], "trigger_hash string"), schemas.BATCH_EVENTS)
    known = [("m0", mail), ("m1", bulk), *[(f"m-p{i}", mail) for i in range(4)]]

    def messages(pairs):
        return spark.createDataFrame(pairs, f"message_id string, headers {headers}")

    table, seen = state_table(spark, rows), {}
    for run in range(1, 4):
        clock = as_of + F.expr(f"INTERVAL {10 * run} MINUTES")
        renewed = jobs.retry_job(table, log, clock, filter_size=2, max_attempts=3).tables
        table, log = (materialize(renewed[n]) for n in ("deal_states", "batch_events"))
        again = states.renewed_batches(log, "filter", clock)
        arrived = known + ([("m2", mail)] if run > 1 else [])
        result = jobs.filter_job(table, log, messages(arrived), clock, batch_size=10, max_attempts=3, retried=again)
        seen[run] = result.summary.first().asDict()
        table, log = materialize(result.tables["deal_states"]), materialize(result.tables["batch_events"])
        found = by_id(table)
        batch = found["e0"][1]
        if run == 1:
            assert [found[f"e{i}"][0] for i in range(4)] == ["pending_classification", "filter_rejected", "filtering", "filtering"]
            parents = {found[f"p{i}"][1] for i in range(5)}
            assert len(parents) == 3 and "mega:1" not in parents
            assert [found[f"p{i}"][0] for i in range(5)] == ["pending_classification"] * 4 + ["filtering"]
    assert found["e2"] == ("pending_classification", batch) and found["e3"] == ("filtering", batch)
    assert [seen[r]["total_unfetched"] for r in (1, 2, 3)] == [3, 2, 2]
    clock = as_of + F.expr("INTERVAL 60 MINUTES")
    swept = jobs.filter_job(table, log, messages(known), clock, max_attempts=3)
    assert by_id(swept.tables["deal_states"])["e3"] == ("failed", batch)


def test_dead_letter_needs_enough_attempts_and_stale_rows(spark, as_of):
    frame = state_table(spark, [
        ("e1", "u", "t", "m1", None, "filtering", "tired", 10),
        ("e2", "u", "t", "m2", None, "filtering", "tired", 1),
        ("e3", "u", "t", "m3", None, "deal", "tired", 10),
        ("e4", "u", "t", "m4", None, "filtering", "fresh", 5),
        ("e5", "u", "t", "m5", None, "filtering", "young", 10),
    ])
    log = [(f"h{i}", "tired", "filter", "retrigger") for i in range(2)] + [(f"g{i}", "fresh", "filter", "retrigger") for i in range(9)]
    log += [("y", "young", "filter", "new")]
    after, new_events = states.dead_letter(frame, events(spark, log), "filtering", "filter", as_of, max_attempts=2)
    assert {k for k, (status, _) in by_id(after).items() if status == "failed"} == {"e1", "e2"}
    assert [(r.batch_id, r.event_type) for r in new_events.collect()] == [("tired", "dead_letter")]


@pytest.mark.parametrize("minutes", [-1, 1.5, "x", None, True])
def test_orphan_minutes_are_checked(spark, as_of, minutes):
    with pytest.raises(TypeError):
        states.fail_orphans(state_table(spark, []), ["classifying"], minutes, as_of)


def test_recovery(spark, as_of):
    rows = [(f"e{i}", "u1" if i < 4 else "u2", "t", f"m{i}", None, "failed", "b", 100 - i) for i in range(6)]
    frame = state_table(spark, rows)
    messages = spark.createDataFrame([("m0",), ("m5",)], "message_id string")
    everyone = by_id(states.recover(frame, messages, as_of))
    assert everyone == {"e0": ("pending", None), "e5": ("pending", None), **{f"e{i}": ("dead", "b") for i in (1, 2, 3, 4)}}
    some = by_id(states.recover(frame, messages, as_of, user_limit=1, rows_per_user=2))
    assert some["e0"] == ("pending", None) and some["e1"] == ("dead", "b")
    assert all(some[f"e{i}"] == ("failed", "b") for i in (2, 3, 4, 5))


def test_sync_twice_adds_nothing(spark, as_of):
    metadata = spark.createDataFrame([("e1", "u", "t", "m1"), ("e2", "u", "t", "m2")], "id string, user_id string, thread_id string, message_id string")
    once = states.sync(state_table(spark, [("e1", "u", "t", "m1", None, "deal", None, 1)]), metadata, as_of)
    assert by_id(once) == {"e1": ("deal", None), "e2": ("pending", None)}
    assert states.sync(once, metadata, as_of).count() == 2


LEGAL = {
    "pending": {"filtering", "pending_classification", "filter_rejected"},
    "filtering": {"failed"},
    "classifying": {"failed"},
    "failed": {"pending", "dead"},
    "(none)": {"pending"},
}


def test_jobs_make_legal_moves_only(spark, as_of, sf_dir):
    from threadsift.registry.inputs import Inputs

    t = Inputs(spark, sf_dir)
    for job in (
        jobs.sync_job(t.deal_states, t.batch_events, t.email_metadata, as_of),
        jobs.filter_job(t.deal_states, t.batch_events, t.state_mails, as_of),
        jobs.recovery_job(t.deal_states, t.messages, as_of),
    ):
        for r in states.transition_counts(t.deal_states, job.tables["deal_states"]).collect():
            assert r.old_status == r.new_status or r.new_status in LEGAL[r.old_status], (r.old_status, r.new_status)
            assert r.new_status in fixed.STATUSES


def test_classification_run_end_to_end(spark, sf_dir):
    """The whole job against plain Python over the same small tables."""
    from threadsift.registry import mutations as registered
    from threadsift.registry.inputs import Inputs

    t = Inputs(spark, sf_dir)
    candidates, raw_replies, messages = registered.classification(t)
    rows = candidates.rows.collect()
    replied = {}
    import hashlib

    for r in candidates.batches.collect():
        replied[r.thread_id] = hashlib.md5(r.thread_id.encode()).hexdigest()[0] < "8"
    skipped = {r.thread_id for r in candidates.skipped.collect()}
    previous = {r.thread_id: r.is_deal for r in t.evaluations.collect()}
    deal_count = 0
    for r in rows:
        verdict = replied.get(r.thread_id)
        if verdict is None:
            verdict = r.thread_id in skipped or previous.get(r.thread_id, False)
        deal_count += bool(verdict)
    assert rows
    summary = registered.snk_6_classify(t).first()
    assert (summary.deal_rows, summary.not_deal_rows) == (deal_count, len(rows) - deal_count)
    assert summary.batches_failed == 0 and summary.rejected_items == 0
    per_batch = candidates.batches.groupBy("batch_id").count().agg(F.max("count")).first()[0]
    assert 1 <= per_batch <= 5


def test_snapshots_are_versioned(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_table(spark, root, "deals").count() == 0
    tables.write_table(spark.createDataFrame([("t1",)], "thread_id string"), root, "deals")
    first = tables.read_table(spark, root, "deals")
    tables.write_table(first.withColumn("deal_name", F.lit("x")), root, "deals")
    assert tables.versions(spark, root, "deals") == [1, 2]
    (tmp_path / "deals" / "v=3").mkdir()
    assert tables.read_table(spark, root, "deals").first().deal_name == "x"
    assert tables.write_table(first, root, "deals") == 4


def part_rows(spark, pairs):
    frame = spark.createDataFrame(pairs, "k string, v int")
    return frame.withColumns({"created_at": F.lit("2020-01-01").cast("timestamp"), "updated_at": F.lit("2020-01-01").cast("timestamp")})


@pytest.mark.parametrize("bound", [0, 500_000])
def test_upserts_in_partitions(spark, tmp_path, as_of, monkeypatch, bound):
    """Equal to the upsert of a whole table; partitions without changes are neither read nor written."""
    monkeypatch.setattr(partitioned, "BROADCAST_KEYS", bound)
    root = str(tmp_path)
    target = part_rows(spark, [*[(f"k{i}", i) for i in range(200)], (None, -1)])
    source = spark.createDataFrame([("k3", 300), ("k4", 400), ("new", 1), (None, 7)], "k string, v int")
    partitioned.write_parts(target, root, "t", ["k"], 32)
    before = {p: v for p, v in partitioned._list(spark, root, "t")[2].items()}
    assert partitioned.upsert_parts(source, root, "t", target.schema, ["k"], ["v"], as_of) == 2
    after = partitioned._list(spark, root, "t")[2]
    want = mutations.upsert(target, source, ["k"], ["v"], as_of)

    def rows(frame):
        return sorted(map(tuple, frame.collect()), key=repr)

    assert rows(partitioned.read_parts(spark, root, "t", target.schema)) == rows(want)
    changed = {p for p, v in after.items() if v == 2}
    assert 1 <= len(changed) <= 4 and {p: v for p, v in after.items() if v == 1} == {p: v for p, v in before.items() if p not in changed}
    # An empty change makes no version; the same change twice gives the same rows.
    assert partitioned.upsert_parts(source.limit(0), root, "t", target.schema, ["k"], ["v"], as_of) == 2
    known = source.filter("k IS NOT NULL")
    partitioned.upsert_parts(known, root, "t", target.schema, ["k"], ["v"], as_of)
    assert rows(partitioned.read_parts(spark, root, "t", target.schema)) == rows(want)


def test_upserts_in_partitions_do_not_move_the_target(spark, tmp_path, as_of, monkeypatch):
    root, plans = str(tmp_path), []
    target = part_rows(spark, [(f"k{i}", i) for i in range(500)])
    partitioned.write_parts(target, root, "t", ["k"], 8)
    original = partitioned._write

    def watched(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return original(rows, *args)

    monkeypatch.setattr(partitioned, "_write", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        partitioned.upsert_parts(spark.createDataFrame([("k1", 5), ("x", 6)], "k string, v int"), root, "t", target.schema, ["k"], ["v"], as_of)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The branch that reads the target has a broadcast join and no exchange between it and the scan.
    branch = plans[0].split("Union")[1].split("\n")
    at = next(i for i, line in enumerate(branch) if "FileScan" in line and "created_at" in line)
    assert any("BroadcastHashJoin" in line for line in branch[:at])
    assert not any("Exchange hashpartitioning" in line or "SortMergeJoin" in line for line in branch[:at])


def test_a_failed_change_leaves_the_table(spark, tmp_path, as_of):
    root = str(tmp_path)
    target = part_rows(spark, [("a", 1), ("b", 2)])
    partitioned.write_parts(target, root, "t", ["k"], 4)
    broken = spark.createDataFrame([("a", 3)], "k string, v int").withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("boom")).cast("int")))
    with pytest.raises(Exception, match="boom"):
        partitioned.upsert_parts(broken, root, "t", target.schema, ["k"], ["v"], as_of)
    with pytest.raises(ValueError):
        partitioned.upsert_parts(target.select("k", "v"), root, "other", target.schema, ["k"], ["v"], as_of)
    assert {r.k: r.v for r in partitioned.read_parts(spark, root, "t", target.schema).collect()} == {"a": 1, "b": 2}
    assert partitioned.upsert_parts(target.select("k", (F.col("v") * 10).alias("v")), root, "t", target.schema, ["k"], ["v"], as_of) > 1
    assert {r.k: r.v for r in partitioned.read_parts(spark, root, "t", target.schema).collect()} == {"a": 10, "b": 20}


def scanned_rows(frame):
    """Rows that the file scan of a frame gave: all of the row groups it did not skip."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves, total = [plan], 0
    while leaves:
        node = leaves.pop()
        children = node.children()
        leaves += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            leaves.append(node.executedPlan())
        if "FileSourceScan" in node.getClass().getSimpleName():
            total += node.metrics().apply("numOutputRows").value()
    return total


def test_look_ups_skip_row_groups(spark, tmp_path):
    """Bloom filters on every looked-up column: few row groups are read, also for columns the file is not sorted by."""
    n = 40_000
    rows = spark.range(n).select(
        F.concat(F.lit("s"), "id").alias("id"), F.concat(F.lit("e"), "id").alias("email_metadata_id"), F.lit("u").alias("user_id"),
        F.concat(F.lit("t"), F.md5(F.col("id").cast("string"))).alias("thread_id"), F.concat(F.lit("m"), F.md5((F.col("id") + 7).cast("string"))).alias("message_id"),
        F.lit("filtering").alias("status"), F.concat(F.lit("b"), F.floor(F.col("id") / 50).cast("string")).alias("batch_id"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 18))
    try:
        tables.write_table(rows.coalesce(1), str(tmp_path), "deal_states")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored = tables.read_table(spark, str(tmp_path), "deal_states")
    thread, message = (r := stored.first()).thread_id, r.message_id
    for frame, found in (
        (states.batch_rows(stored, "b77"), 50),
        (lookups.with_ids(stored, "thread_id", spark.createDataFrame([(thread,), ("none",), (None,)], "thread_id string")), 1),
        (lookups.with_ids(stored, "message_id", spark.createDataFrame([(message,)], "m string"), "m"), 1),
        (lookups.with_ids(stored, "thread_id", spark.createDataFrame([], "thread_id string")), 0),
    ):
        assert frame.count() == found
        assert scanned_rows(frame) <= n / 4
    many = stored.select("thread_id").limit(lookups.NAMED_IDS + 5)
    assert lookups.with_ids(stored, "thread_id", many).count() == lookups.NAMED_IDS + 5


def test_bucketed_state_table_is_updated_without_moving_it(spark, tmp_path, as_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(f"e{i}", "u", f"t{i % 9}", f"m{i}", None, "pending", None, 1) for i in range(50)]
        stored = tables.write_bucketed(state_table(spark, rows), str(tmp_path), "deal_states", buckets=4)
        changes = spark.createDataFrame([("e1", "failed"), ("e2", "dead")], "email_metadata_id string, status string")
        after = mutations.apply_changes(stored, changes, as_of)
        plan = after._jdf.queryExecution().executedPlan().toString()
        got = by_id(after)
        assert (got["e1"], got["e2"], got["e3"]) == (("failed", None), ("dead", None), ("pending", None))
        assert plan.count("Exchange hashpartitioning") == 1, plan
        again = tables.write_bucketed(after, str(tmp_path), "deal_states", buckets=4)
        assert by_id(again) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_adds_new_mail_once(spark, tmp_path, as_of):
    source, target = str(tmp_path / "in"), str(tmp_path / "states")
    meta = spark.createDataFrame([(f"e{i}", "u", "t", f"m{i}") for i in range(4)], "id string, user_id string, thread_id string, message_id string")
    meta.write.parquet(source)
    sync.prepare_states(state_table(spark, [("e0", "u", "t", "m0", None, "deal", None, 1)]), target)
    arriving = spark.readStream.schema(meta.schema).parquet(source)
    for checkpoint in ("c1", "c1", "c2"):
        sync.start_sync(arriving, target, str(tmp_path / checkpoint), as_of).awaitTermination()
    got = by_id(sync.read_states(spark, target))
    assert got == {"e0": ("deal", None), **{f"e{i}": ("pending", None) for i in (1, 2, 3)}}
    assert sync.read_states(spark, target).count() == 4


def test_stream_reads_states_once_and_survives_a_restart(spark, tmp_path):
    """A second micro-batch scans no state file; a repeated one changes nothing; the clock is its own."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "states", "c"))
    columns = "id string, user_id string, thread_id string, message_id string"

    def arrive(ids):
        spark.createDataFrame([(i, "u", "t", f"m{i}") for i in ids], columns).coalesce(1).write.mode("append").parquet(source)

    arrive(["e0", "e1", "e1"])
    arrive(["e0", "e2", "e1"])
    sync.prepare_states(state_table(spark, [(e, "u", "t", "m", None, "deal", None, 1) for e in ("e0", "e2")]), target)
    plans = []
    original = sync.new_states

    def watched(batch, as_of):
        plans.append(batch._jdf.queryExecution().logical().toString())
        return original(batch, as_of)

    sync.new_states = watched
    try:
        arriving = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(source)
        query = sync.start_sync(arriving, target, checkpoint)
        query.awaitTermination()
        # [rows of states, rows of metadata] of each micro-batch
        read = [[s["numInputRows"] for s in p["sources"]] for p in query.recentProgress if p["sources"]]
        assert read[0][0] == 2 and all(r[0] == 0 for r in read[1:]) and len(read) >= 2
        after = sync.read_states(spark, target)
        assert by_id(after) == {"e0": ("deal", None), "e1": ("pending", None), "e2": ("deal", None)}
        assert after.count() == 3
        added = after.filter("status = 'pending'").first()
        assert added.created_at == added.updated_at and added.created_at.year >= 2025
        # Another run brings one known mail, one new one, and one that another job has added to the table.
        state_table(spark, [("e9", "u", "t", "m", None, "not_deal", None, 1)]).write.parquet(f"{target}/other")
        arrive(["e1", "e3", "e9"])
        sync.start_sync(arriving, target, checkpoint).awaitTermination()
        assert by_id(sync.read_states(spark, target)) == {
            "e0": ("deal", None), "e1": ("pending", None), "e2": ("deal", None), "e3": ("pending", None), "e9": ("not_deal", None),
        }
        # The last micro-batch was not committed: it runs again and replaces what it wrote.
        last = sorted((tmp_path / "c" / "commits").glob("[0-9]*"))[-1]
        for file in (last, last.with_name(f".{last.name}.crc")):
            file.unlink(missing_ok=True)
        sync.start_sync(arriving, target, checkpoint).awaitTermination()
        assert sync.read_states(spark, target).count() == 5
    finally:
        sync.new_states = original
    assert plans


def test_numbering_keeps_rows_without_key_or_id(spark):
    rows = spark.createDataFrame([("u", "a"), (None, "b"), ("u", None), (None, None)], "user_id string, id string")
    got = ranking.in_chunks(rows, ["user_id"], "id", 1).collect()
    assert sorted((r.user_id or "", r.id or "", r.chunk_no) for r in got) == [
        ("", "", 0), ("", "b", 1), ("u", "", 0), ("u", "a", 1)
    ]


def test_two_classification_runs_of_one_user(spark):
    """Audits, events and states of a later run stand beside those of the first; failed batches wait and are retried."""
    from threadsift.registry.inputs import Inputs

    def stamp(text):
        return F.lit(text).cast("timestamp")

    names = ["email_metadata_id", "user_id", "thread_id", "message_id"]
    rows = [("e1", "u", "t1", "m1"), ("e2", "u", "t2", "m2")]
    deal_states = spark.createDataFrame(rows, names).select(
        F.concat(F.lit("s"), "email_metadata_id").alias("id"), *names, F.lit("y").alias("sync_state_id"),
        F.when(F.col("thread_id") == "t1", "pending_classification").otherwise("filtering").alias("status"),
        F.lit(None).cast("string").alias("batch_id"), stamp("2024-01-01").alias("created_at"), stamp("2024-01-01").alias("updated_at"),
    )
    deal_states = deal_states.withColumn("sync_state_id", F.col("thread_id"))
    header = "array<struct<name:string,value:string>>"
    messages = spark.createDataFrame(
        [("m1", [("From", "a@b.co")], None, "Hello", 1), ("m2", [("From", "a@b.co")], None, "Hi", 1)],
        f"message_id string, headers {header}, body string, reply_body string, position long",
    )
    empty = {name: spark.createDataFrame([], schema) for name, schema in {**schemas.DEAL_TABLES, **schemas.MAIL_TABLES}.items()}
    tables = {**empty, "deal_states": deal_states}

    def run(as_of, raw, retried=None):
        found = jobs.select_candidates(
            tables["deal_states"], tables["email_thread_evaluations"], tables["user_sync_settings"], tables["deals"], messages, retried=retried
        )
        replies_ = found.batches.select("batch_id", F.lit("primary").alias("layer"), F.lit("m").alias("model"), F.lit(raw).alias("raw"))
        result = jobs.classify_job(tables, found, replies_, messages, stamp(as_of))
        for name, frame in result.tables.items():
            tables[name] = spark.createDataFrame(frame.collect(), frame.schema)
        return result.summary.first()

    deal = '[{"thread_index": 1, "is_deal": true, "category": "new"}]'
    assert run("2024-02-01", deal).batches_processed == 1
    tables["deal_states"] = tables["deal_states"].withColumn(
        "status", F.when(F.col("status") == "filtering", "pending_classification").otherwise(F.col("status"))
    )
    # The second run's reply cannot be read: its rows wait under their batch.
    failed = run("2024-03-01", "no json")
    assert (failed.batches_processed, failed.batches_failed) == (0, 1)
    state = {r.thread_id: r for r in tables["deal_states"].collect()}
    assert state["t1"].status == "deal" and state["t2"].status == "classifying"
    assert state["t1"].batch_id != state["t2"].batch_id and state["t2"].batch_id
    renewed = jobs.retry_job(tables["deal_states"], tables["batch_events"], stamp("2024-03-02"))
    assert renewed.summary.first().batches_renewed == 1
    for name, frame in renewed.tables.items():
        tables[name] = spark.createDataFrame(frame.collect(), frame.schema)
    retried = tables["batch_events"].filter("event_type = 'retrigger'").select("batch_id")
    assert run("2024-03-02", deal, retried).batches_processed == 1
    state = {r.thread_id: r for r in tables["deal_states"].collect()}
    assert state["t2"].status == "deal"
    audits = tables["ai_evaluation_audits"].collect()
    assert sorted(a.batch_id for a in audits) == sorted(s.batch_id for s in state.values())
    done = {e.batch_id for e in tables["batch_events"].collect() if e.event_type == "complete"}
    assert done == {s.batch_id for s in state.values()}
