"""What replies change in the evaluation, deal, contact and state tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.operators import contacts, mails, mutations, outcomes
from threadsift.operators import replies as reply_ops
from threadsift.registry import query
from threadsift.registry import reply_inputs as given
from threadsift.registry.mail_rules import blocked_sql
from threadsift.registry.replies import COERCED, items

AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"
_ITEMS = f"(SELECT * FROM ({COERCED}) c WHERE shape <> 'broken') i"


def thread_users(t):
    """Thread -> user of the mails the replies are about."""
    return t.emails.select(F.concat(F.lit("th-"), F.col("k").cast("string")).alias("thread_id"), "user_id")


_USERS = "(SELECT 'th-' || CAST(k AS STRING) AS thread_id, user_id FROM f_emails) u"


# ---- states ------------------------------------------------------------------------
_LATEST = f"""
SELECT s.thread_id, MAX(CASE WHEN m.date_text <> 'not a date' THEN m.sent_at END) AS latest_mail_at
FROM f_deal_states s JOIN f_messages m ON m.message_id = s.message_id GROUP BY s.thread_id"""
_SKIPPED = f"""
SELECT l.thread_id FROM ({_LATEST}) l JOIN f_deals d ON d.thread_id = l.thread_id
WHERE l.latest_mail_at <= d.updated_at"""


def state_mail_dates(t):
    placed = mails.enrich(t.state_mails, t.deal_states).filter(F.col("thread_id").isNotNull())
    return mails.latest_mail_dates(placed)


@query("out_1_already_evaluated", _SKIPPED)
def out_1(t):
    return outcomes.already_evaluated(state_mail_dates(t), t.deals)


_UNAVAILABLE = """
SELECT s.thread_id FROM f_deal_states s LEFT JOIN f_messages m ON m.message_id = s.message_id
WHERE s.status = 'classifying' GROUP BY s.thread_id HAVING COUNT(m.message_id) = 0"""


@query("joi_15_unavailable_threads", f"""
SELECT x.thread_id, COALESCE(e.is_deal, FALSE) AS was_deal FROM ({_UNAVAILABLE}) x
LEFT JOIN f_evaluations e ON e.thread_id = x.thread_id""")
def joi_15(t):
    rows = t.deal_states.filter(F.col("status") == "classifying")
    gone = outcomes.unavailable_threads(rows, t.messages)
    return gone.join(t.evaluations, "thread_id", "left").select(
        "thread_id", F.coalesce("is_deal", F.lit(False)).alias("was_deal")
    )


# Reply items about the state table's threads: one verdict per thread in the reply.
_REPLIED = """
SELECT thread_id, COUNT(*) % 2 = 1 AS is_deal FROM f_deal_states
WHERE status = 'classifying' AND user_id IN (SELECT user_id FROM f_user_settings) GROUP BY thread_id"""


@query("sta_11_terminal_outcomes", f"""
SELECT s.email_metadata_id, CASE WHEN r.is_deal THEN 'deal' WHEN NOT r.is_deal THEN 'not_deal'
 WHEN k.thread_id IS NOT NULL THEN 'deal' WHEN e.is_deal THEN 'deal' ELSE 'not_deal' END AS status
FROM f_deal_states s LEFT JOIN ({_REPLIED}) r ON r.thread_id = s.thread_id
LEFT JOIN ({_SKIPPED}) k ON k.thread_id = s.thread_id LEFT JOIN f_evaluations e ON e.thread_id = s.thread_id
WHERE s.status = 'classifying'""")
def sta_11(t):
    rows = t.deal_states.filter(F.col("status") == "classifying")
    replied = (
        rows.join(t.user_settings, "user_id", "left_semi")
        .groupBy("thread_id")
        .agg((F.count(F.lit(1)) % 2 == 1).alias("is_deal"))
    )
    skipped = outcomes.already_evaluated(state_mail_dates(t), t.deals)
    return outcomes.terminal_changes(rows, replied, skipped, t.evaluations)


# ---- rows ---------------------------------------------------------------------------
_EVALUATIONS = f"""
SELECT SHA256('evaluation|' || thread_id) AS id, thread_id, '' AS ai_evaluation_audit_id,
 COALESCE(category, '') AS ai_insight, ai_summary, is_deal, COALESCE(category, '') = 'likely_scam' AS likely_scam, ai_score,
 {AS_OF} AS created_at, {AS_OF} AS updated_at FROM {_ITEMS}"""


@query("out_2_evaluation_rows", _EVALUATIONS)
def out_2(t):
    return outcomes.evaluation_rows(items(t), t.as_of)


_DEALS = f"""
SELECT i.thread_id AS id, u.user_id, i.thread_id, '' AS email_thread_evaluation_id,
 REPLACE(REPLACE(deal_name, '“', '"'), '”', '"') AS deal_name, deal_type, category, CAST({{value}} AS DOUBLE) AS value,
 {{currency}} AS currency, 'Brand' AS brand, TRUE AS is_ai_sorted, {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM {_ITEMS} LEFT JOIN {_USERS} ON u.thread_id = i.thread_id WHERE is_deal"""


@query("out_3_deal_rows", _DEALS.format(value="0", currency="'USD'"))
def out_3(t):
    return outcomes.deal_rows(items(t), thread_users(t), t.as_of)


@query("out_3b_deal_rows_with_values", _DEALS.format(value="COALESCE(deal_value, 0)", currency="'EUR'"))
def out_3b(t):
    return outcomes.deal_rows(items(t), thread_users(t), t.as_of, value_from_number=True)


def stored_deals(t):
    """A deals table over the replies' threads: every mail of documents with a label."""
    labels = t.labels.select(F.concat(F.lit("th-"), F.col("doc_id").cast("string")).alias("thread_id"))
    return labels.select(
        F.col("thread_id").alias("id"),
        F.lit("old-user").alias("user_id"),
        "thread_id",
        F.lit("old").alias("deal_name"),
        F.lit("new").alias("category"),
        F.lit(False).alias("is_ai_sorted"),
        F.lit("2023-12-01 00:00:00").cast("timestamp").alias("created_at"),
        F.lit("2023-12-02 00:00:00").cast("timestamp").alias("updated_at"),
    )


_STORED = """
SELECT 'th-' || CAST(doc_id AS STRING) AS id, 'old-user' AS user_id, 'th-' || CAST(doc_id AS STRING) AS thread_id,
 'old' AS deal_name, 'new' AS category, FALSE AS is_ai_sorted, TIMESTAMP '2023-12-01 00:00:00' AS created_at,
 TIMESTAMP '2023-12-02 00:00:00' AS updated_at FROM labels"""
_LEFT = f"SELECT * FROM ({_STORED}) d WHERE thread_id NOT IN (SELECT thread_id FROM {_ITEMS} WHERE NOT is_deal)"


@query("out_4_remove_non_deals", _LEFT)
def out_4(t):
    return mutations.delete_matching(stored_deals(t), outcomes.no_longer_deals(items(t)), "thread_id")


@query("out_4b_deals_after_replies", f"""
SELECT COALESCE(o.id, n.id) AS id, COALESCE(o.user_id, n.user_id) AS user_id, COALESCE(o.thread_id, n.thread_id) AS thread_id,
 COALESCE(n.deal_name, o.deal_name) AS deal_name, COALESCE(n.category, o.category) AS category,
 COALESCE(o.is_ai_sorted, n.is_ai_sorted) AS is_ai_sorted, COALESCE(o.created_at, {AS_OF}) AS created_at,
 CASE WHEN n.id IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM ({_LEFT}) o FULL JOIN ({_DEALS.format(value="0", currency="'USD'")}) n ON n.thread_id = o.thread_id""")
def out_4b(t):
    found = items(t)
    left = mutations.delete_matching(stored_deals(t), outcomes.no_longer_deals(found), "thread_id")
    return mutations.upsert_table("deals", left, outcomes.deal_rows(found, thread_users(t), t.as_of), t.as_of)


# ---- contacts ------------------------------------------------------------------------
def _fallback_mails(t):
    """Mails of the replies' threads: one thread per mail."""
    return t.mails.withColumns(
        {"thread_id": F.concat(F.lit("th-"), F.col("k").cast("string")), "position": F.col("k")}
    )


def _creators(t):
    return thread_users(t).withColumn("creator_email", F.concat(F.lit("u"), "user_id", F.lit("@creator.com")))


def _stored_senders(t):
    """Stored senders for the replies' threads, from part of the mails."""
    meta = t.emails.select(
        F.col("message_id").alias("id"),
        F.concat(F.lit("th-"), F.col("k").cast("string")).alias("thread_id"),
        "user_id",
        F.col("sent_at").alias("received_at"),
    )
    senders = t.labels.select(
        F.concat(F.lit("m-"), F.col("doc_id").cast("string")).alias("email_metadata_id"),
        F.concat(F.lit("Store"), F.col("quality").cast("string"), F.lit("@agency.co")).alias("sender_email"),
        F.lit("").alias("sender_name"),
    )
    settings = _creators(t).select("user_id", F.col("creator_email").alias("email")).distinct()
    return contacts.latest_stored_sender(meta, senders, settings)


def resolved(t):
    deals = items(t).filter("is_deal").select("batch_id", "pos", "thread_id", "main_contact")
    deals = deals.join(_creators(t), "thread_id", "left")
    from_headers = contacts.latest_header_sender(_fallback_mails(t), _creators(t))
    return contacts.resolve_contacts(deals, from_headers, _stored_senders(t))


_FROM = """LOWER(TRIM(CASE WHEN CONTAINS(from_value, '<') THEN REGEXP_EXTRACT(from_value, '<([^>]+)>', 1) ELSE from_value END))"""
_FROM_NAME = """NULLIF(CASE WHEN CONTAINS(from_value, '<') THEN TRIM(TRIM(SPLIT_PART(from_value, '<', 1)), '"') ELSE '' END, '')"""
_RESOLVED = f"""
SELECT batch_id, thread_index, thread_id, user_id,
 CASE source WHEN 'reply' THEN contact_email WHEN 'headers' THEN h WHEN 'senders' THEN s END AS email,
 CASE source WHEN 'reply' THEN contact_name WHEN 'headers' THEN hn END AS name,
 CASE source WHEN 'reply' THEN contact_company END AS company, source AS contact_source
FROM (SELECT *, CASE WHEN e <> '' AND e <> creator AND NOT {blocked_sql('e')} THEN 'reply'
  WHEN h <> '' AND h <> creator AND NOT {blocked_sql('h')} THEN 'headers' WHEN s IS NOT NULL THEN 'senders' ELSE 'none' END AS source
 FROM (SELECT i.*, m.user_id, 'u' || m.user_id || '@creator.com' AS creator, LOWER(TRIM(COALESCE(i.contact_email, ''))) AS e,
  {_FROM} AS h, {_FROM_NAME} AS hn, CASE WHEN l.doc_id IS NOT NULL THEN 'store' || CAST(l.quality AS STRING) || '@agency.co' END AS s
  FROM {_ITEMS} JOIN f_emails m ON 'th-' || CAST(m.k AS STRING) = i.thread_id LEFT JOIN labels l ON l.doc_id = m.k
  WHERE i.is_deal) a) b"""


@query("out_6_resolved_contacts", f"SELECT thread_id, user_id, email, name, company, contact_source FROM ({_RESOLVED}) r")
def out_6(t):
    return resolved(t).select(
        "thread_id",
        "user_id",
        F.col("contact.email").alias("email"),
        F.col("contact.name").alias("name"),
        F.col("contact.company").alias("company"),
        "contact_source",
    )


@query("out_6b_fallback_counts", f"""
SELECT COUNT(*) FILTER (WHERE contact_source <> 'reply') AS candidates,
 COUNT(*) FILTER (WHERE contact_source IN ('headers', 'senders')) AS recovered,
 COUNT(*) FILTER (WHERE contact_source = 'headers') AS from_headers,
 COUNT(*) FILTER (WHERE contact_source = 'senders') AS from_senders FROM ({_RESOLVED}) r""")
def out_6b(t):
    return outcomes.fallback_counts(resolved(t))


_PEOPLE = f"""
SELECT user_id, email, name, company AS company_name FROM (
 SELECT user_id, LOWER(TRIM(email)) AS email, name, company,
  ROW_NUMBER() OVER (PARTITION BY user_id, LOWER(TRIM(email)) ORDER BY batch_id DESC, thread_index DESC) AS rn
 FROM ({_RESOLVED}) r WHERE contact_source <> 'none') x WHERE rn = 1"""


@query("out_7_contact_rows", _PEOPLE)
def out_7(t):
    people, _ = outcomes.contact_rows(resolved(t), t.as_of)
    return people.select("user_id", "email", "name", "company_name")


@query("out_7b_deal_contact_rows", f"""
SELECT thread_id AS deal_id, user_id, LOWER(TRIM(email)) AS email, 'primary' AS contact_type
FROM ({_RESOLVED}) r WHERE contact_source <> 'none'""")
def out_7b(t):
    _, links = outcomes.contact_rows(resolved(t), t.as_of)
    return links.select("deal_id", "user_id", "email", "contact_type")


@query("win_7_last_contact_wins", """
SELECT user_id, email, name FROM (
 SELECT CAST(CAST(FLOOR(doc_id / 40) AS BIGINT) AS STRING) AS user_id, source || '@brand.com' AS email, CAST(doc_id AS STRING) AS name,
  ROW_NUMBER() OVER (PARTITION BY FLOOR(doc_id / 40), source ORDER BY doc_id DESC) AS rn FROM documents) x WHERE rn = 1""")
def win_7(t):
    writes = t.documents.select(
        F.floor(F.col("doc_id") / 40).cast("string").alias("user_id"),
        F.concat("source", F.lit("@brand.com")).alias("email"),
        F.col("doc_id").cast("string").alias("name"),
        F.col("doc_id").alias("sequence"),
    )
    return mutations.last_write(writes, ["user_id", "email"], ["sequence"]).drop("sequence")


# ---- audits ---------------------------------------------------------------------------
def _audits(t):
    parsed = reply_ops.parse_replies(given.layered(t.replies))
    best = reply_ops.first_usable_reply(parsed)
    found = reply_ops.reply_items(best.select("batch_id", "items"), given.batch_order(t.replies))
    counts = t.replies.groupBy("batch_id").agg(F.count(F.lit(1)).alias("email_count"))
    return outcomes.audit_rows(best.filter(F.col("layer").isNotNull()), found, counts, t.as_of)


_AUDITED = "SELECT * FROM f_replies WHERE shape <> 'broken' OR batch_id % 16 < 12"


@query("out_8_audit_rows", f"""
SELECT SHA256('audit|' || CAST(batch_id AS STRING)) AS id, batch_id, COUNT(*) AS thread_count,
 COUNT(*) AS email_count, CAST(0 AS DOUBLE) AS inference_cost, CAST(0 AS BIGINT) AS input_tokens, CAST(0 AS BIGINT) AS output_tokens,
 CASE WHEN shape <> 'broken' THEN 'big-model' WHEN batch_id % 16 = 3 THEN 'big-model(corrective-retry)' ELSE 'small-model' END AS model_used,
 STRING_AGG(thread_id, ',' ORDER BY thread_index) AS threads
FROM ({_AUDITED}) r GROUP BY batch_id, shape""")
def out_8(t):
    stored = F.try_parse_json("ai_evaluation")
    listed = F.try_variant_get(stored, "$.threads", "array<struct<thread_id:string>>")
    return (
        _audits(t)
        .withColumn("threads", F.array_join(F.transform(listed, lambda x: x["thread_id"]), ","))
        .drop("ai_evaluation", "created_at")
    )
