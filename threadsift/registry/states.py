"""State machine queries over the whole state table."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.operators import mutations, states
from threadsift.plans import jobs
from threadsift.registry import query
from threadsift.session import materialize
from threadsift.sources import lookups

AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
STATE_COLUMNS = "id, email_metadata_id, user_id, thread_id, message_id, sync_state_id"


@query("flt_1_batch_rows", """
SELECT batch_id, email_metadata_id, message_id, user_id, thread_id, sync_state_id
FROM f_deal_states WHERE batch_id IS NOT NULL""")
def flt_1(t):
    return states.batch_rows(t.deal_states)


@query("flt_2_batch_id_pairs", """
SELECT batch_id, email_metadata_id, thread_id FROM f_deal_states WHERE batch_id IS NOT NULL""")
def flt_2(t):
    return states.batch_id_pairs(t.deal_states)


@query("flt_3_batch_thread_users", """
SELECT DISTINCT batch_id, thread_id, user_id FROM f_deal_states WHERE batch_id IS NOT NULL""")
def flt_3(t):
    return states.batch_thread_users(t.deal_states)


@query("flt_4_evaluations_of_deal_threads", """
SELECT e.thread_id, e.is_deal FROM f_evaluations e WHERE e.thread_id IN (SELECT thread_id FROM f_deals)""")
def flt_4(t):
    return lookups.with_ids(t.evaluations, "thread_id", t.deals).select("thread_id", "is_deal")


@query("flt_4b_deals_of_ready_threads", """
SELECT d.id, d.thread_id, d.user_id, d.updated_at FROM f_deals d
WHERE d.thread_id IN (SELECT thread_id FROM f_deal_states WHERE status = 'classifying')""")
def flt_4b(t):
    wanted = t.deal_states.filter(F.col("status") == "classifying")
    return lookups.with_ids(t.deals, "thread_id", wanted).select("id", "thread_id", "user_id", "updated_at")


@query("flt_5_stale_rows", f"""
SELECT email_metadata_id, status, updated_at FROM f_deal_states
WHERE updated_at < {AS_OF} - 30 * INTERVAL '1' MINUTE""")
def flt_5(t):
    from threadsift.functions.scalars import minutes_before

    return t.deal_states.filter(F.col("updated_at") < minutes_before(t.as_of, 30)).select(
        "email_metadata_id", "status", "updated_at"
    )


@query("flt_6_processed_without_batch", """
SELECT user_id, CAST(SUM(CASE WHEN batch_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS without_batch,
 CAST(SUM(CASE WHEN status NOT IN ('pending', 'filtering', 'pending_classification', 'classifying') THEN 1 ELSE 0 END)
  AS BIGINT) AS processed
FROM f_deal_states GROUP BY user_id""")
def flt_6(t):
    from threadsift.operators.eligibility import is_processed

    return t.deal_states.groupBy("user_id").agg(
        F.count_if(F.col("batch_id").isNull()).alias("without_batch"),
        F.count_if(is_processed()).alias("processed"),
    )


@query("flt_7_failed_rows_of_users", """
SELECT id, email_metadata_id, message_id, user_id, thread_id, sync_state_id
FROM f_deal_states WHERE status = 'failed'""")
def flt_7(t):
    return states.failed_rows(t.deal_states, user_limit=None, rows_per_user=None)


@query("joi_1_rows_with_evaluation_and_creator", """
SELECT s.batch_id, s.email_metadata_id, s.message_id, s.user_id, s.thread_id, s.sync_state_id,
 e.ai_summary AS previous_ai_summary, e.is_deal AS previous_is_deal, u.email AS creator_email
FROM f_deal_states s LEFT JOIN f_evaluations e ON e.thread_id = s.thread_id
LEFT JOIN f_user_settings u ON u.user_id = s.user_id WHERE s.batch_id IS NOT NULL""")
def joi_1(t):
    return states.with_previous_evaluation(states.batch_rows(t.deal_states), t.evaluations, t.user_settings)


_ATTEMPTS = f"""
SELECT s.batch_id, COUNT(DISTINCT e.trigger_hash) AS attempts
FROM f_deal_states s LEFT JOIN f_batch_events e ON e.batch_id = s.batch_id
WHERE s.status = '{{status}}' AND s.batch_id IS NOT NULL
 AND s.updated_at < {AS_OF} - 5 * INTERVAL '1' MINUTE
GROUP BY s.batch_id"""


@query("joi_3_stale_batch_attempts", _ATTEMPTS.format(status="filtering"))
def joi_3(t):
    return states.stale_batch_attempts(t.deal_states, t.batch_events, "filtering", t.as_of)


@query("joi_4_metadata_without_state", """
SELECT m.id, m.user_id, m.thread_id, m.message_id FROM f_email_metadata m
WHERE NOT EXISTS (SELECT 1 FROM f_deal_states s WHERE s.email_metadata_id = m.id)""")
def joi_4(t):
    return states.missing_states(t.deal_states, t.email_metadata, t.as_of).select(
        F.col("email_metadata_id").alias("id"), "user_id", "thread_id", "message_id"
    )


# A thread is complete if one of its syncs has rows ready and none unfinished; rows without a sync wait for nobody.
_COMPLETE = """
SELECT DISTINCT thread_id FROM (
 SELECT thread_id, sync_state_id, COUNT(*) FILTER (WHERE status = 'pending_classification') AS ready,
  COUNT(*) FILTER (WHERE status IN ('pending', 'filtering')) AS unfinished
 FROM f_deal_states GROUP BY thread_id, sync_state_id) g
WHERE ready > 0 AND (unfinished = 0 OR sync_state_id IS NULL OR thread_id IS NULL)"""


@query("joi_5_complete_threads", _COMPLETE)
def joi_5(t):
    return states.complete_threads(t.deal_states)


@query("joi_6_rows_of_oldest_pending", """
SELECT email_metadata_id, status, updated_at FROM f_deal_states WHERE email_metadata_id IN (
 SELECT email_metadata_id FROM f_deal_states WHERE status = 'pending' ORDER BY updated_at, email_metadata_id LIMIT 200)""")
def joi_6(t):
    oldest = states.oldest_rows(t.deal_states, "pending", 200)
    return lookups.with_ids(t.deal_states, "email_metadata_id", oldest).select("email_metadata_id", "status", "updated_at")


@query("joi_14_failed_rows_by_availability", """
SELECT s.email_metadata_id, s.message_id, m.message_id IS NOT NULL AS is_available
FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id WHERE s.status = 'failed'""")
def joi_14(t):
    failed = t.deal_states.filter(F.col("status") == "failed").select("email_metadata_id", "message_id")
    return states.split_by_availability(failed, t.messages)


@query("agg_1_count_by_batch_and_status", """
SELECT batch_id, status, COUNT(*) AS "count" FROM f_deal_states WHERE batch_id IS NOT NULL GROUP BY batch_id, status""")
def agg_1(t):
    return states.count_by_batch_and_status(t.deal_states)


@query("agg_1b_count_orphans", f"""
SELECT COUNT(*) AS c FROM f_deal_states
WHERE status IN ('pending_classification', 'classifying') AND batch_id IS NULL
 AND updated_at < {AS_OF} - 30 * INTERVAL '1' MINUTE""")
def agg_1b(t):
    return states.count_orphans(t.deal_states, ["pending_classification", "classifying"], 30, t.as_of)


@query("agg_2_stuck_batches", f"SELECT * FROM ({_ATTEMPTS.format(status='classifying')}) a WHERE attempts < 6")
def agg_2(t):
    return states.stuck_batches(t.deal_states, t.batch_events, "classifying", t.as_of)


@query("agg_2b_dead_batches", f"SELECT * FROM ({_ATTEMPTS.format(status='filtering')}) a WHERE attempts >= 6")
def agg_2b(t):
    return states.dead_batches(t.deal_states, t.batch_events, "filtering", t.as_of)


@query("agg_3_users_with_failures", """
SELECT user_id, MIN(updated_at) AS oldest FROM f_deal_states WHERE status = 'failed'
GROUP BY user_id ORDER BY oldest, user_id LIMIT 200""")
def agg_3(t):
    return states.users_with_failures(t.deal_states, 200)


_FAILED = """
SELECT id, email_metadata_id, message_id, user_id, thread_id, sync_state_id FROM (
 SELECT s.*, ROW_NUMBER() OVER (PARTITION BY s.user_id ORDER BY s.updated_at, s.email_metadata_id) AS rn
 FROM f_deal_states s WHERE s.status = 'failed' AND s.user_id IN (
  SELECT user_id FROM f_deal_states WHERE status = 'failed'
  GROUP BY user_id ORDER BY MIN(updated_at), user_id LIMIT 200)) x WHERE rn <= 2"""


@query("win_3_oldest_failed_rows", _FAILED)
def win_3(t):
    return states.failed_rows(t.deal_states, user_limit=200, rows_per_user=2)


_ROW_CHUNKS = """
SELECT s.*, CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY MD5(email_metadata_id), email_metadata_id) - 1) / 5)
  AS BIGINT) AS chunk_no FROM f_deal_states s WHERE batch_id IS NOT NULL"""
_THREAD_CHUNKS = """
SELECT batch_id, thread_id, CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY MD5(thread_id), thread_id) - 1) / 3)
  AS BIGINT) AS chunk_no
FROM (SELECT DISTINCT batch_id, thread_id FROM f_deal_states WHERE batch_id IS NOT NULL) d"""
_SUB_ID = "SHA256('sub|' || batch_id || '|' || CAST(chunk_no AS STRING))"


@query("win_5_row_chunks", f"SELECT email_metadata_id, {_SUB_ID} AS sub_batch_id FROM ({_ROW_CHUNKS}) c")
def win_5(t):
    return states.row_sub_batches(states.batch_rows(t.deal_states), 5)


@query("win_5b_thread_chunks", f"SELECT batch_id, thread_id, {_SUB_ID} AS sub_batch_id FROM ({_THREAD_CHUNKS}) c")
def win_5b(t):
    return states.thread_sub_batches(states.batch_rows(t.deal_states), 3)


@query("win_5c_user_chunks", """
SELECT user_id, email_metadata_id,
 CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY MD5(email_metadata_id), email_metadata_id) - 1) / 4) AS BIGINT)
  AS chunk_no
FROM f_deal_states""")
def win_5c(t):
    from threadsift.operators.ranking import in_chunks

    rows = t.deal_states.select("user_id", "email_metadata_id")
    return in_chunks(rows, ["user_id"], "email_metadata_id", 4)


@query("srt_2_ordered_claim", """
SELECT email_metadata_id, updated_at FROM f_deal_states WHERE status = 'pending_classification'
ORDER BY updated_at, email_metadata_id LIMIT 100""")
def srt_2(t):
    return states.oldest_rows(t.deal_states, "pending_classification", 100).select("email_metadata_id", "updated_at")


# ---- transitions ---------------------------------------------------------------
_SYNCED = f"""
SELECT {STATE_COLUMNS}, status, batch_id, created_at, updated_at FROM f_deal_states
UNION ALL SELECT SHA256('state|' || m.id), m.id, m.user_id, m.thread_id, m.message_id, NULL, 'pending', NULL, {AS_OF}, {AS_OF}
FROM f_email_metadata m WHERE NOT EXISTS (SELECT 1 FROM f_deal_states s WHERE s.email_metadata_id = m.id)"""


@query("sta_1_sync", _SYNCED)
def sta_1(t):
    return states.sync(t.deal_states, t.email_metadata, t.as_of)


@query("snk_3_sync_counts", f"""
SELECT status, COUNT(*) AS n FROM ({_SYNCED}) s GROUP BY status""")
def snk_3(t):
    synced = states.sync(t.deal_states, t.email_metadata, t.as_of)
    return synced.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _updated(status_sql: str, batch_sql: str, hit_sql: str, source: str = "f_deal_states s") -> str:
    return f"""
SELECT s.id, s.email_metadata_id, s.user_id, s.thread_id, s.message_id, s.sync_state_id,
 {status_sql} AS status, {batch_sql} AS batch_id, s.created_at,
 CASE WHEN {hit_sql} THEN {AS_OF} ELSE s.updated_at END AS updated_at FROM {source}"""


_CLAIMED = """s.email_metadata_id IN (SELECT email_metadata_id FROM f_deal_states WHERE status = 'pending'
 ORDER BY updated_at, email_metadata_id LIMIT 200)"""


@query("sta_2_claim_for_filter", _updated(
    f"CASE WHEN {_CLAIMED} THEN 'filtering' ELSE s.status END",
    f"CASE WHEN {_CLAIMED} THEN 'claim-1' ELSE s.batch_id END", _CLAIMED))
def sta_2(t):
    return states.claim_for_filter(t.deal_states, "claim-1", t.as_of, limit=200)


_READY = f"(s.status = 'pending_classification' AND s.thread_id IN ({_COMPLETE}))"


@query("sta_3_claim_for_classification", _updated(
    f"CASE WHEN {_READY} THEN 'classifying' ELSE s.status END",
    f"CASE WHEN {_READY} THEN 'claim-2' ELSE s.batch_id END", _READY))
def sta_3(t):
    return states.claim_for_classification(t.deal_states, "claim-2", t.as_of)


@query("sta_4_row_sub_batches", _updated(
    "s.status", "CASE WHEN s.batch_id IS NOT NULL THEN c.sub ELSE s.batch_id END", "s.batch_id IS NOT NULL",
    f"f_deal_states s LEFT JOIN (SELECT email_metadata_id AS eid, {_SUB_ID} AS sub FROM ({_ROW_CHUNKS}) x) c "
    "ON c.eid = s.email_metadata_id"))
def sta_4(t):
    pieces = states.row_sub_batches(states.batch_rows(t.deal_states), 5)
    return states.assign_sub_batches(
        t.deal_states, pieces, ["email_metadata_id"], F.col("batch_id").isNotNull(), t.as_of
    )


@query("sta_4b_thread_sub_batches", _updated(
    "s.status", "CASE WHEN s.batch_id IS NOT NULL THEN c.sub ELSE s.batch_id END", "s.batch_id IS NOT NULL",
    f"f_deal_states s LEFT JOIN (SELECT batch_id AS b, thread_id AS th, {_SUB_ID} AS sub FROM ({_THREAD_CHUNKS}) x) c "
    "ON c.b = s.batch_id AND c.th = s.thread_id"))
def sta_4b(t):
    pieces = states.thread_sub_batches(states.batch_rows(t.deal_states), 3)
    return states.assign_sub_batches(
        t.deal_states, pieces, ["batch_id", "thread_id"], F.col("batch_id").isNotNull(), t.as_of
    )


_SENT = "(s.message_id IN (SELECT message_id FROM f_messages))"


@query("sta_5_status_by_ids", _updated(
    f"CASE WHEN {_SENT} THEN 'pending_classification' ELSE s.status END", "s.batch_id", _SENT))
def sta_5(t):
    ids = t.deal_states.join(t.messages.select("message_id"), "message_id", "left_semi")
    return states.set_status_by_ids(t.deal_states, ids, "pending_classification", t.as_of)


_EVENT_BATCH = "(s.status = 'classifying' AND s.batch_id IN (SELECT batch_id FROM f_batch_events))"


@query("sta_5b_status_by_batch", _updated(
    f"CASE WHEN {_EVENT_BATCH} THEN 'failed' ELSE s.status END", "s.batch_id", f"({_EVENT_BATCH})"))
def sta_5b(t):
    return states.set_status_by_batches(t.deal_states, t.batch_events, "classifying", "failed", t.as_of)


@query("sta_6_refresh_batches", _updated(
    "s.status", "s.batch_id", "s.batch_id IN (SELECT batch_id FROM f_batch_events WHERE event_type = 'new')"))
def sta_6(t):
    return states.refresh_batches(t.deal_states, t.batch_events.filter(F.col("event_type") == "new"), t.as_of)


_STUCK = f"SELECT batch_id FROM ({_ATTEMPTS.format(status='filtering')}) a WHERE attempts < 6"
_DEAD = f"SELECT batch_id FROM ({_ATTEMPTS.format(status='filtering')}) a WHERE attempts >= 6"


@query("sta_7_retry_stuck", _updated("s.status", "s.batch_id", f"s.batch_id IN ({_STUCK})"))
def sta_7(t):
    return states.retry_stuck(t.deal_states, t.batch_events, "filtering", "filter", t.as_of, 50)[0]


@query("sta_7b_retry_events", f"""
SELECT SHA256('retrigger|' || batch_id || '|2024-01-20 00:00:00.000000') AS trigger_hash, batch_id,
 'filter' AS batch_type, 'retrigger' AS event_type, {AS_OF} AS created_at FROM ({_STUCK}) s""")
def sta_7b(t):
    return states.retry_stuck(t.deal_states, t.batch_events, "filtering", "filter", t.as_of, 50)[1]


# The state table with parent batches: half of the rows with a batch are still in one of a larger claim.
_PARENTS = """SELECT s.*, CASE WHEN batch_id IS NOT NULL AND CAST(SUBSTR(email_metadata_id, 4) AS BIGINT) % 1000 < 500
 THEN 'mega:' || CAST(CAST(FLOOR(CAST(SUBSTR(email_metadata_id, 4) AS BIGINT) / 700) AS BIGINT) AS STRING) ELSE batch_id END AS b
FROM f_deal_states s"""


def parent_states(t):
    key = F.substring("email_metadata_id", 4, 20).cast("bigint")
    parent = F.concat(F.lit(fixed.MEGA_BATCH_PREFIX), F.floor(key / 700).cast("string"))
    return t.deal_states.withColumn("batch_id", F.when(F.col("batch_id").isNotNull() & (key % 1000 < 500), parent).otherwise(F.col("batch_id")))


_PARENT_ATTEMPTS = f"""SELECT p.b, COUNT(DISTINCT e.trigger_hash) AS attempts FROM parents p LEFT JOIN f_batch_events e ON e.batch_id = p.b
 WHERE p.status = 'filtering' AND p.b IS NOT NULL AND p.updated_at < {AS_OF} - 5 * INTERVAL '1' MINUTE GROUP BY p.b"""


@query("sta_7c_retry_splits_parents", f"""
WITH parents AS ({_PARENTS}), attempts AS ({_PARENT_ATTEMPTS}),
chunks AS (SELECT p.*, a.b IS NOT NULL AS hit,
 CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY p.b ORDER BY MD5(email_metadata_id), email_metadata_id) - 1) / 5) AS BIGINT) AS chunk_no
 FROM parents p LEFT JOIN attempts a ON a.b = p.b AND a.attempts < 6)
SELECT id, email_metadata_id, user_id, thread_id, message_id, sync_state_id, status,
 CASE WHEN hit AND STARTS_WITH(b, 'mega:') THEN SHA256('sub|' || b || '|' || CAST(chunk_no AS STRING)) ELSE b END AS batch_id,
 created_at, CASE WHEN hit THEN {AS_OF} ELSE updated_at END AS updated_at FROM chunks""")
def sta_7_parents(t):
    return states.retry_stuck(parent_states(t), t.batch_events, "filtering", "filter", t.as_of, 5)[0]


# Messages of every fourth mail arrive only after the first filter run.
@query("sta_7d_second_filter_run", f"""
WITH parents AS ({_PARENTS}),
attempts AS (SELECT p.b, COUNT(DISTINCT e.trigger_hash) AS attempts FROM parents p LEFT JOIN f_batch_events e ON e.batch_id = p.b
 WHERE p.b IS NOT NULL GROUP BY p.b),
judged AS (SELECT p.*, a.attempts, CASE WHEN m.message_id IS NULL THEN 'filtering'
 WHEN STARTS_WITH(LOWER(m.from_value), 'no-reply@') OR LOWER(m.from_value) LIKE '"the team"%' OR m.subject_value = 'Weekly Digest'
 THEN 'filter_rejected' ELSE 'pending_classification' END AS verdict
 FROM parents p LEFT JOIN f_messages m ON m.message_id = p.message_id LEFT JOIN attempts a ON a.b = p.b)
SELECT email_metadata_id, CASE WHEN status = 'pending' THEN verdict WHEN status = 'filtering' AND b IS NOT NULL THEN
 CASE WHEN attempts >= 6 THEN 'failed' ELSE verdict END ELSE status END AS status FROM judged""")
def sta_7_second_run(t):
    later = t.as_of + F.expr("INTERVAL 10 MINUTES")
    early = t.state_mails.filter(F.substring("message_id", 5, 20).cast("bigint") % 4 != 0)
    first = jobs.filter_job(parent_states(t), t.batch_events, early, t.as_of, batch_size=50).tables
    renewed = jobs.retry_job(materialize(first["deal_states"]), materialize(first["batch_events"]), later, filter_size=5).tables
    log = materialize(renewed["batch_events"])
    again = states.renewed_batches(log, "filter", later)
    second = jobs.filter_job(materialize(renewed["deal_states"]), log, t.state_mails, later, batch_size=50, retried=again)
    return second.tables["deal_states"].select("email_metadata_id", "status")


_DEAD_ROW = f"(s.status = 'filtering' AND s.batch_id IN ({_DEAD}))"


@query("sta_8_dead_letter", _updated(
    f"CASE WHEN {_DEAD_ROW} THEN 'failed' ELSE s.status END", "s.batch_id", _DEAD_ROW))
def sta_8(t):
    return states.dead_letter(t.deal_states, t.batch_events, "filtering", "filter", t.as_of)[0]


_ORPHAN = f"""(s.status IN ('pending_classification', 'classifying') AND s.batch_id IS NULL
 AND s.updated_at < {AS_OF} - 30 * INTERVAL '1' MINUTE)"""


@query("sta_9_fail_orphans", _updated(
    f"CASE WHEN {_ORPHAN} THEN 'failed' ELSE s.status END", "s.batch_id", _ORPHAN))
def sta_9(t):
    return states.fail_orphans(t.deal_states, ["pending_classification", "classifying"], 30, t.as_of)


_RECOVERED = """SELECT s.*, CASE WHEN s.status = 'failed' THEN s.email_metadata_id END AS rid, m.message_id AS mid
FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id"""


@query("sta_10_recover", f"""
SELECT {STATE_COLUMNS},
 CASE WHEN rid IS NULL THEN status WHEN mid IS NOT NULL THEN 'pending' ELSE 'dead' END AS status,
 CASE WHEN rid IS NOT NULL AND mid IS NOT NULL THEN NULL ELSE batch_id END AS batch_id, created_at,
 CASE WHEN rid IS NOT NULL THEN {AS_OF} ELSE updated_at END AS updated_at FROM ({_RECOVERED}) x""")
def sta_10(t):
    return states.recover(t.deal_states, t.messages, t.as_of)


@query("sta_10b_recover_everyone", f"""
SELECT status, COUNT(*) AS n FROM (
 SELECT CASE WHEN s.status <> 'failed' THEN s.status WHEN m.message_id IS NOT NULL THEN 'pending' ELSE 'dead' END AS status
 FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id) x GROUP BY status""")
def sta_10b(t):
    after = states.recover(t.deal_states, t.messages, t.as_of, user_limit=None, rows_per_user=None)
    return after.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("sta_12_event_log", f"""
SELECT trigger_hash, batch_id, batch_type, event_type, created_at FROM f_batch_events
UNION ALL SELECT SHA256('dead_letter|' || batch_id || '|2024-01-20 00:00:00.000000'), batch_id, 'filter', 'dead_letter', {AS_OF}
FROM ({_DEAD}) d
UNION ALL SELECT DISTINCT batch_id, batch_id, 'classify', 'complete', {AS_OF} FROM f_deal_states WHERE status = 'classifying' AND batch_id IS NOT NULL""")
def sta_12(t):
    dead = states.dead_letter(t.deal_states, t.batch_events, "filtering", "filter", t.as_of)[1]
    done = t.deal_states.filter((F.col("status") == "classifying") & F.col("batch_id").isNotNull())
    done = states.event_rows(done.select("batch_id").distinct(), "classify", "complete", t.as_of)
    return mutations.upsert_table("batch_events", t.batch_events, dead.unionByName(done), t.as_of)


@query("agg_10_transition_counts", """
SELECT s.status AS old_status,
 CASE WHEN s.status <> 'failed' THEN s.status WHEN m.message_id IS NOT NULL THEN 'pending' ELSE 'dead' END AS new_status,
 COUNT(*) AS n
FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id GROUP BY 1, 2""")
def agg_10(t):
    after = states.recover(t.deal_states, t.messages, t.as_of, user_limit=None, rows_per_user=None)
    return states.transition_counts(t.deal_states, after)


_STUCK_IDS = "SELECT batch_id FROM ({}) a WHERE attempts < 6"


# A batch renewed in one step is fresh in the other.
@query("snk_6e_retry_summary", f"""
SELECT COUNT(*) AS batches_renewed, CAST(0 AS BIGINT) AS batches_split_off FROM (
 {_STUCK_IDS.format(_ATTEMPTS.format(status='filtering'))} UNION {_STUCK_IDS.format(_ATTEMPTS.format(status='classifying'))}) b""")
def snk_6_retry(t):
    return jobs.retry_job(t.deal_states, t.batch_events, t.as_of).summary
