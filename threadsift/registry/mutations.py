"""Table changes, snapshots and job summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadsift import schemas
from threadsift.functions import scalars
from threadsift.operators import mutations, outcomes
from threadsift.plans import jobs
from threadsift.registry import query
from threadsift.registry.replies import COERCED, items
from threadsift.session import shared_folder
from threadsift.sources import partitioned, tables

AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
OLD = "TIMESTAMP '2023-12-01 00:00:00'"


def _old(column: str):
    return F.lit("2023-12-01 00:00:00").cast("timestamp").alias(column)


# ---- SNK-1: audits --------------------------------------------------------------------
_STORED_AUDITS = """SELECT 'b-' || CAST(doc_id AS STRING) AS batch_id, 'stored' AS model_used FROM labels"""
_NEW_AUDITS = """SELECT 'b-' || CAST(doc_id AS STRING) AS batch_id, 'fresh' AS model_used FROM documents"""


@query("snk_1_append_audits", f"""
SELECT * FROM ({_STORED_AUDITS}) s UNION ALL
SELECT * FROM ({_NEW_AUDITS}) n WHERE batch_id NOT IN (SELECT batch_id FROM ({_STORED_AUDITS}) s)""")
def snk_1(t):
    batch_id = F.concat(F.lit("b-"), F.col("doc_id").cast("string")).alias("batch_id")
    stored = t.labels.select(batch_id, F.lit("stored").alias("model_used"))
    fresh = t.documents.select(batch_id, F.lit("fresh").alias("model_used"))
    return mutations.append_missing(stored, fresh, "batch_id")


# ---- SNK-2: upserts -------------------------------------------------------------------
@query("snk_2_upsert_line_items", f"""
SELECT COALESCE(o.l_orderkey, n.l_orderkey) AS l_orderkey, COALESCE(o.l_linenumber, n.l_linenumber) AS l_linenumber,
 COALESCE(n.quantity, o.quantity) AS quantity, COALESCE(o.flag, n.flag) AS flag,
 CASE WHEN o.l_orderkey IS NOT NULL THEN o.created_at ELSE {AS_OF} END AS created_at,
 CASE WHEN n.l_orderkey IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT l_orderkey, l_linenumber, MAX(l_quantity) AS quantity, 'old' AS flag, {OLD} AS created_at, {OLD} AS updated_at
 FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2) o
FULL JOIN (SELECT l_orderkey, l_linenumber, MAX(l_quantity) + 100 AS quantity, 'new' AS flag
 FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2) n
ON n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber""")
def snk_2(t):
    keys = ["l_orderkey", "l_linenumber"]
    target = (
        t.lineitem.filter("l_returnflag <> 'R'")
        .groupBy(*keys)
        .agg(F.max("l_quantity").alias("quantity"))
        .select(*keys, "quantity", F.lit("old").alias("flag"), _old("created_at"), _old("updated_at"))
    )
    source = (
        t.lineitem.filter("l_returnflag <> 'N'")
        .groupBy(*keys)
        .agg((F.max("l_quantity") + 100).alias("quantity"))
        .withColumn("flag", F.lit("new"))
    )
    return mutations.upsert(target, source, keys, ["quantity"], t.as_of)


_EVERY = 100


@query("snk_2f_upsert_changed_parts", f"""
SELECT COALESCE(o.o_orderkey, n.o_orderkey) AS o_orderkey, COALESCE(n.status, o.status) AS status,
 COALESCE(o.created_at, {AS_OF}) AS created_at, CASE WHEN n.o_orderkey IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT o_orderkey, o_orderstatus AS status, {OLD} AS created_at, {OLD} AS updated_at FROM orders WHERE o_orderkey % 3 <> 0) o
FULL JOIN (SELECT o_orderkey, 'X' AS status FROM orders WHERE o_custkey % {_EVERY} = 1) n ON n.o_orderkey = o.o_orderkey""")
def snk_2_parts(t):
    """An upsert of a few keys into a table in partitions: two versions, of which the second holds what changed."""
    root = f"{shared_folder(t.spark)}/parts-{uuid.uuid4().hex}"
    kept = t.orders.filter("o_orderkey % 3 <> 0")
    target = kept.select("o_orderkey", F.col("o_orderstatus").alias("status"), _old("created_at"), _old("updated_at"))
    source = t.orders.filter(F.col("o_custkey") % _EVERY == 1).select("o_orderkey", F.lit("X").alias("status"))
    partitioned.write_parts(target, root, "orders", ["o_orderkey"], 16)
    partitioned.upsert_parts(source, root, "orders", target.schema, ["o_orderkey"], ["status"], t.as_of)
    return partitioned.read_parts(t.spark, root, "orders", target.schema)


_ITEMS = f"(SELECT * FROM ({COERCED}) c WHERE shape <> 'broken') i"


@query("snk_2a_upsert_evaluations", f"""
SELECT COALESCE(o.id, n.id) AS id, COALESCE(o.thread_id, n.thread_id) AS thread_id,
 CASE WHEN n.thread_id IS NOT NULL THEN n.ai_summary ELSE o.ai_summary END AS ai_summary,
 COALESCE(n.is_deal, o.is_deal) AS is_deal, COALESCE(n.ai_score, o.ai_score) AS ai_score,
 COALESCE(o.created_at, {AS_OF}) AS created_at, CASE WHEN n.thread_id IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT 'old-' || CAST(doc_id AS STRING) AS id, 'th-' || CAST(doc_id AS STRING) AS thread_id, 'old' AS ai_summary,
  quality = 1 AS is_deal, 1 AS ai_score, {OLD} AS created_at, {OLD} AS updated_at FROM labels) o
FULL JOIN (SELECT SHA256('evaluation|' || thread_id) AS id, thread_id, ai_summary, is_deal, ai_score FROM {_ITEMS}) n
ON n.thread_id = o.thread_id""")
def snk_2a(t):
    doc = F.col("doc_id").cast("string")
    target = t.labels.select(
        F.concat(F.lit("old-"), doc).alias("id"),
        F.concat(F.lit("th-"), doc).alias("thread_id"),
        F.lit("old").alias("ai_summary"),
        (F.col("quality") == 1).alias("is_deal"),
        F.lit(1).alias("ai_score"),
        _old("created_at"),
        _old("updated_at"),
    )
    return mutations.upsert_table("evaluations", target, outcomes.evaluation_rows(items(t), t.as_of), t.as_of)


@query("snk_2b_upsert_deals", f"""
SELECT COALESCE(o.id, n.thread_id) AS id, COALESCE(o.thread_id, n.thread_id) AS thread_id,
 CASE WHEN o.id IS NOT NULL THEN o.user_id ELSE n.user_id END AS user_id, COALESCE(n.category, o.category) AS category,
 CASE WHEN o.id IS NOT NULL THEN o.is_ai_sorted ELSE TRUE END AS is_ai_sorted,
 CASE WHEN n.thread_id IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT id, thread_id, user_id, category, FALSE AS is_ai_sorted, updated_at FROM f_deals) o
FULL JOIN (SELECT thread_id, MAX(user_id) AS user_id, 'completed' AS category FROM f_email_metadata GROUP BY thread_id) n
ON n.thread_id = o.thread_id""")
def snk_2b(t):
    target = t.deals.select(
        "id", "thread_id", "user_id", "category", F.lit(False).alias("is_ai_sorted"), "updated_at"
    )
    source = (
        t.email_metadata.groupBy("thread_id")
        .agg(F.max("user_id").alias("user_id"))
        .select(
            F.col("thread_id").alias("id"),
            "thread_id",
            "user_id",
            F.lit("completed").alias("category"),
            F.lit(True).alias("is_ai_sorted"),
        )
    )
    return mutations.upsert_table("deals", target, source, t.as_of)


@query("snk_2c_upsert_deal_contacts", f"""
SELECT COALESCE(o.deal_id, n.deal_id) AS deal_id, COALESCE(o.user_id, n.user_id) AS user_id, COALESCE(o.email, n.email) AS email,
 COALESCE(n.contact_type, o.contact_type) AS contact_type, COALESCE(o.created_at, {AS_OF}) AS created_at,
 CASE WHEN n.deal_id IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT *, {OLD} AS created_at, {OLD} AS updated_at FROM f_deal_contacts WHERE email NOT LIKE 'c0@%') o
FULL JOIN (SELECT deal_id, user_id, email, 'secondary' AS contact_type FROM f_deal_contacts WHERE email NOT LIKE 'c1@%') n
ON n.deal_id = o.deal_id AND n.user_id = o.user_id AND n.email = o.email""")
def snk_2c(t):
    target = t.deal_contacts.filter("email NOT LIKE 'c0@%'").select("*", _old("created_at"), _old("updated_at"))
    source = t.deal_contacts.filter("email NOT LIKE 'c1@%'").withColumn("contact_type", F.lit("secondary"))
    return mutations.upsert_table("deal_contacts", target, source, t.as_of)


@query("snk_2d_upsert_contacts", f"""
SELECT COALESCE(o.user_id, n.user_id) AS user_id, COALESCE(o.email, n.email) AS email,
 CASE WHEN n.email IS NOT NULL THEN n.name ELSE o.name END AS name,
 CASE WHEN n.email IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM (SELECT user_id, email, 'kept' AS name, {OLD} AS updated_at FROM f_contacts) o
FULL JOIN (SELECT DISTINCT user_id, email, CASE WHEN email LIKE 'c1@%' THEN 'new' END AS name FROM f_deal_contacts) n
ON n.user_id = o.user_id AND n.email = o.email""")
def snk_2d(t):
    target = t.contacts.select("user_id", "email", F.lit("kept").alias("name"), _old("updated_at"))
    source = t.deal_contacts.select(
        "user_id", "email", F.when(F.col("email").like("c1@%"), "new").alias("name")
    ).distinct()
    return mutations.upsert_table("contacts", target, source, t.as_of)


@query("snk_2e_upsert_batch_events", f"""
SELECT COALESCE(o.trigger_hash, n.batch_id) AS trigger_hash, COALESCE(o.batch_id, n.batch_id) AS batch_id,
 CASE WHEN o.trigger_hash IS NOT NULL THEN o.batch_type ELSE 'filter' END AS batch_type,
 CASE WHEN n.batch_id IS NOT NULL THEN 'complete' ELSE o.event_type END AS event_type,
 CASE WHEN n.batch_id IS NOT NULL THEN {AS_OF} ELSE o.created_at END AS created_at
FROM (SELECT DISTINCT batch_id AS trigger_hash, batch_id, 'filter' AS batch_type, 'new' AS event_type, {OLD} AS created_at
 FROM f_batch_events WHERE event_type = 'new') o
FULL JOIN (SELECT DISTINCT batch_id FROM f_batch_events WHERE event_type = 'retrigger') n ON n.batch_id = o.trigger_hash""")
def snk_2e(t):
    from threadsift.operators.states import event_rows

    created = t.batch_events.filter("event_type = 'new'").select("batch_id").distinct()
    done = t.batch_events.filter("event_type = 'retrigger'").select("batch_id").distinct()
    target = event_rows(created, "filter", "new", _old("created_at"))
    return mutations.upsert_table("batch_events", target, event_rows(done, "filter", "complete", t.as_of), t.as_of)


# ---- SNK-4: deletes -------------------------------------------------------------------
@query("snk_4a_delete_deals_by_thread", """
SELECT id, thread_id FROM f_deals WHERE thread_id NOT IN (SELECT thread_id FROM f_evaluations WHERE NOT is_deal)""")
def snk_4a(t):
    doomed = t.evaluations.filter(~F.col("is_deal"))
    return mutations.delete_matching(t.deals, doomed, "thread_id").select("id", "thread_id")


@query("snk_4b_delete_deal_contacts", """
SELECT deal_id, user_id, email FROM f_deal_contacts WHERE deal_id NOT IN (SELECT thread_id FROM f_evaluations WHERE NOT is_deal)""")
def snk_4b(t):
    doomed = t.evaluations.filter(~F.col("is_deal"))
    return mutations.delete_matching(t.deal_contacts, doomed, "deal_id", "thread_id").select("deal_id", "user_id", "email")


# ---- scalar clean-up ------------------------------------------------------------------
_QUOTED = "text || ' ‘a’ “b” ‚c‛ „d‟'"


@query("sca_3_straight_quotes", f"""
SELECT doc_id, {"REPLACE(" * 8}{_QUOTED}{"".join(f", '{q}', '{s}')" for q, s in (("‘", "''"), ("’", "''"), ("‚", "''"), ("‛", "''"), ("“", '"'), ("”", '"'), ("„", '"'), ("‟", '"')))} AS plain
FROM documents""")
def sca_3(t):
    text = F.concat(F.col("text"), F.lit(" ‘a’ “b” ‚c‛ „d‟"))
    return t.documents.select("doc_id", scalars.straight_quotes(text).alias("plain"))


_IDS = "SELECT CASE doc_id % 3 WHEN 0 THEN 'th-' || CAST(doc_id AS STRING) WHEN 1 THEN 'th ' || CAST(doc_id AS STRING) ELSE source || ':' || lang END AS id FROM documents"


@query("sca_4_quarantined_ids", f"SELECT id, COUNT(*) AS n FROM ({_IDS}) i WHERE id LIKE '% %' GROUP BY id")
def sca_4(t):
    doc = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 3
    ids = t.documents.select(
        F.when(kind == 0, F.concat(F.lit("th-"), doc))
        .when(kind == 1, F.concat(F.lit("th "), doc))
        .otherwise(F.concat("source", F.lit(":"), "lang"))
        .alias("id")
    )
    _, rejected = scalars.split_by_valid_id(ids, "id")
    return rejected.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("sca_5_empty_to_null", "SELECT email_metadata_id, NULLIF(sender_name, '') AS name FROM f_senders")
def sca_5(t):
    return t.senders.select("email_metadata_id", scalars.blank_to_null(F.col("sender_name")).alias("name"))


@query("sca_9_numbers", """
SELECT user_id, COALESCE(TRY_CAST(integer_value AS DOUBLE), 0) AS n FROM f_markers""")
def sca_9(t):
    return t.markers.select("user_id", scalars.number_or_zero(F.col("integer_value")).alias("n"))


# ---- SRC-1: snapshots -----------------------------------------------------------------
@query("src_1_snapshots", f"""
SELECT COALESCE(o.deal_id, n.deal_id) AS deal_id, COALESCE(n.contact_type, o.contact_type) AS contact_type,
 CASE WHEN n.deal_id IS NOT NULL THEN {AS_OF} END AS updated_at
FROM f_deal_contacts o LEFT JOIN (SELECT id AS deal_id, 'secondary' AS contact_type FROM f_deals WHERE category = 'new') n
ON n.deal_id = o.deal_id""")
def src_1(t):
    """Two versions of a table: the first as given, the second after an upsert of the first."""
    root = f"{shared_folder(t.spark)}/tables-{uuid.uuid4().hex}"
    tables.write_table(t.deal_contacts, root, "deal_contacts")
    first = tables.read_table(t.spark, root, "deal_contacts")
    touched = t.deals.filter("category = 'new'").select(F.col("id").alias("deal_id"))
    source = t.deal_contacts.join(touched, "deal_id", "left_semi").withColumn("contact_type", F.lit("secondary"))
    tables.write_table(mutations.upsert_table("deal_contacts", first, source, t.as_of), root, "deal_contacts")
    return tables.read_table(t.spark, root, "deal_contacts").select("deal_id", "contact_type", "updated_at")


# ---- SNK-6: job summaries -------------------------------------------------------------
_DEAD = """SELECT COUNT(*) FROM f_deal_states s WHERE s.status = '{0}' AND s.batch_id IN (
 SELECT s.batch_id FROM f_deal_states s JOIN f_batch_events e ON e.batch_id = s.batch_id
 WHERE s.status = '{0}' AND s.updated_at < """ + AS_OF + """ - 5 * INTERVAL '1' MINUTE
 GROUP BY s.batch_id HAVING COUNT(DISTINCT e.trigger_hash) >= 6)"""


@query("snk_6_sync_summary", f"""
SELECT (SELECT COUNT(*) FROM f_email_metadata m WHERE NOT EXISTS (SELECT 1 FROM f_deal_states s WHERE s.email_metadata_id = m.id)) AS synced_count,
 ({_DEAD.format('filtering')}) + ({_DEAD.format('classifying')}) AS dead_lettered""")
def snk_6_sync(t):
    return jobs.sync_job(t.deal_states, t.batch_events, t.email_metadata, t.as_of).summary


_VERDICTS = """SELECT s.user_id, s.email_metadata_id, CASE WHEN m.message_id IS NULL THEN NULL
 WHEN STARTS_WITH(LOWER(m.from_value), 'no-reply@') OR LOWER(m.from_value) LIKE '"the team"%'
  OR m.subject_value = 'Weekly Digest' THEN 'rejected' ELSE 'passed' END AS verdict
FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id WHERE s.status = 'pending'"""


@query("snk_6b_filter_summary", f"""
SELECT (SELECT CAST(SUM(CEIL(n / 3.0)) AS BIGINT) FROM (SELECT user_id, COUNT(*) AS n FROM ({_VERDICTS}) v GROUP BY user_id) c) AS batches_processed,
 (SELECT COUNT(*) FROM ({_VERDICTS}) v WHERE verdict = 'passed') AS total_filtered,
 (SELECT COUNT(*) FROM ({_VERDICTS}) v WHERE verdict = 'rejected') AS total_rejected,
 (SELECT COUNT(*) FROM ({_VERDICTS}) v WHERE verdict IS NULL) AS total_unfetched,
 ({_DEAD.format('filtering')}) AS stuck_failed""")
def snk_6_filter(t):
    return jobs.filter_job(t.deal_states, t.batch_events, t.state_mails, t.as_of, batch_size=3).summary


@query("snk_6c_recovery_summary", """
SELECT COUNT(m.message_id) AS total_recovered, COUNT(*) - COUNT(m.message_id) AS total_dead, COUNT(DISTINCT s.user_id) AS users_processed
FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id WHERE s.status = 'failed'""")
def snk_6_recovery(t):
    return jobs.recovery_job(t.deal_states, t.messages, t.as_of, None, None).summary


def classification(t):
    """Candidates of the state table and a reply to each of their batches."""
    messages = t.state_mails.select(
        "message_id",
        "headers",
        F.lit(None).cast("string").alias("body"),
        F.lit("Hello, we pay for a post.").alias("reply_body"),
        F.expr("CAST(SUBSTR(message_id, 5) AS BIGINT)").alias("position"),
    )
    candidates = jobs.select_candidates(t.deal_states, t.evaluations, t.user_settings, t.deals, messages)
    verdict = F.struct("thread_index", (F.substring(F.md5("thread_id"), 1, 1) < "8").alias("is_deal"), F.lit("new").alias("category"))
    raw_replies = candidates.batches.groupBy("batch_id").agg(
        F.to_json(F.array_sort(F.collect_list(verdict))).alias("raw")
    )
    raw_replies = raw_replies.select("batch_id", F.lit("primary").alias("layer"), F.lit("big-model").alias("model"), "raw")
    return candidates, raw_replies, messages


_CLAIMED = """
SELECT s.* FROM f_deal_states s JOIN (
 SELECT thread_id, MAX(CASE WHEN ready > 0 AND (unfinished = 0 OR sync_state_id IS NULL) THEN 1 ELSE 0 END) AS complete FROM (
  SELECT thread_id, sync_state_id, COUNT(*) FILTER (WHERE status = 'pending_classification') AS ready,
   COUNT(*) FILTER (WHERE status IN ('pending', 'filtering')) AS unfinished
  FROM f_deal_states GROUP BY thread_id, sync_state_id) g GROUP BY thread_id) t ON t.thread_id = s.thread_id
WHERE s.status = 'pending_classification' AND t.complete = 1"""
_CLAIMED_THREADS = f"""
SELECT c.thread_id, MAX(c.user_id) AS user_id, COUNT(m.message_id) AS messages,
 MAX(CASE WHEN m.date_text <> 'not a date' THEN m.sent_at END) <= MAX(d.updated_at) AS covered
FROM ({_CLAIMED}) c LEFT JOIN f_messages m ON m.message_id = c.message_id LEFT JOIN f_deals d ON d.thread_id = c.thread_id
GROUP BY c.thread_id"""


@query("snk_6d_classify_summary", f"""
SELECT COUNT(*) FILTER (WHERE deal) AS deal_rows, COUNT(*) FILTER (WHERE NOT deal) AS not_deal_rows,
 (SELECT CAST(SUM(CEIL(n / 5.0)) AS BIGINT) FROM (SELECT user_id, COUNT(*) AS n FROM ({_CLAIMED_THREADS}) x
  WHERE messages > 0 AND COALESCE(NOT covered, TRUE) GROUP BY user_id) u) AS batches_processed,
 CAST(0 AS BIGINT) AS batches_failed, CAST(0 AS BIGINT) AS rejected_items, ({_DEAD.format('classifying')}) AS stuck_failed,
 (SELECT COUNT(*) FROM f_deal_states s WHERE s.status = 'pending_classification' AND s.batch_id IS NULL
  AND s.updated_at < {AS_OF} - 30 * INTERVAL '1' MINUTE
  AND s.email_metadata_id NOT IN (SELECT c.email_metadata_id FROM ({_CLAIMED}) c)) AS orphan_failed
FROM (SELECT CASE WHEN t.messages > 0 AND COALESCE(NOT t.covered, TRUE) THEN SUBSTR(MD5(c.thread_id), 1, 1) < '8'
  ELSE COALESCE(t.covered, FALSE) OR COALESCE(e.is_deal, FALSE) END AS deal
 FROM ({_CLAIMED}) c JOIN ({_CLAIMED_THREADS}) t ON t.thread_id = c.thread_id
 LEFT JOIN f_evaluations e ON e.thread_id = c.thread_id) r""")
def snk_6_classify(t):
    """Outcome of a whole classification run over the state table."""
    candidates, raw_replies, messages = classification(t)
    given = {
        "email_thread_evaluations": schemas.conform(t.evaluations, schemas.EVALUATIONS),
        "deals": schemas.conform(t.deals, schemas.DEALS),
        "contacts": schemas.conform(t.contacts, schemas.CONTACTS),
        "deal_contacts": schemas.conform(t.deal_contacts, schemas.DEAL_CONTACTS),
        "ai_evaluation_audits": t.spark.createDataFrame([], schemas.AUDITS),
        "batch_events": t.batch_events,
        "deal_states": t.deal_states,
        "email_metadata": t.email_metadata,
        "email_senders": t.senders,
        "user_sync_settings": t.user_settings,
    }
    result = jobs.classify_job(given, candidates, raw_replies, messages, t.as_of)
    return result.summary
