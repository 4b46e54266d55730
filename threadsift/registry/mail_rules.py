"""Header access and rejection rules over all mails."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions import headers as hdr
from threadsift.functions import rules
from threadsift.operators import contacts, mails
from threadsift.registry import query
from threadsift.session import shared_folder
from threadsift.sources import documents


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def blocked_sql(a: str) -> str:
    """SQL condition: address column `a` (lower case, trimmed) is blocked."""
    prefixes = " OR ".join(f"STARTS_WITH({a}, '{p}')" for p in fixed.BLOCKED_PREFIXES)
    tokens = " OR ".join(
        f"(CONTAINS({a}, '@') AND CONTAINS(SUBSTR({a}, STRPOS({a}, '@') + 1), '{t}'))" for t in fixed.BLOCKED_DOMAIN_TOKENS
    )
    return f"({a} = '' OR {prefixes} OR {tokens})"


_ADDRESS = """LOWER(TRIM(CASE WHEN CONTAINS(from_value, '<')
 THEN REGEXP_EXTRACT(from_value, '<([^>]+)>', 1) ELSE from_value END))"""
_NAME = """CASE WHEN CONTAINS(from_value, '<')
 THEN TRIM(TRIM(SPLIT_PART(from_value, '<', 1)), '"') ELSE '' END"""
_DATE = "CASE WHEN date_value IS NULL OR date_value = 'not a date' THEN NULL ELSE sent_at END"


@query("hdr_1_header_values", """
SELECT k, from_value AS sender, subject_value AS subject, COALESCE(auth_value, '') AS auth,
 COALESCE(list_id_value, '') AS list_id, COALESCE(date_value, '') AS date_text FROM f_emails""")
def hdr_1(t):
    h = F.col("headers")
    return t.mails.select(
        "k",
        hdr.header(h, "from").alias("sender"),
        hdr.header(h, "SUBJECT").alias("subject"),
        hdr.header(h, "authentication-results").alias("auth"),
        hdr.header(h, "List-ID").alias("list_id"),
        hdr.header(h, "date").alias("date_text"),
    )


@query("hdr_2_addresses", f"SELECT k, {_ADDRESS} AS address FROM f_emails")
def hdr_2(t):
    return t.mails.select("k", hdr.address(hdr.header(F.col("headers"), "from")).alias("address"))


@query("hdr_3_display_names", f"SELECT k, {_NAME} AS display_name FROM f_emails")
def hdr_3(t):
    return t.mails.select("k", hdr.display_name(hdr.header(F.col("headers"), "from")).alias("display_name"))


@query("sca_6_mail_dates", f"SELECT k, {_DATE} AS sent FROM f_emails")
def sca_6(t):
    return t.mails.select("k", hdr.mail_date(hdr.header(F.col("headers"), "date")).alias("sent"))


def _any_contains(column: str, words) -> str:
    return "(" + " OR ".join(f"CONTAINS({column}, '{w}')" for w in words) + ")"


_VALUES = "LOWER(CONCAT_WS(chr(10), from_value, subject_value, auth_value, list_id_value, precedence_value, x_mailer_value, date_value))"
_RULES = {
    "auth": "(auth_value IS NOT NULL AND auth_value <> '' AND NOT "
    + _any_contains("auth_value", fixed.AUTH_PASS_MARKS)
    + ")",
    "sender": f"(address <> '' AND {blocked_sql('address')})",
    "bulk_header": "(list_id_value IS NOT NULL OR precedence_value IS NOT NULL OR "
    + _any_contains(_VALUES, fixed.MAILING_TOOLS)
    + ")",
    "subject": _any_contains("LOWER(subject_value)", fixed.AUTOMATED_SUBJECT_TERMS),
    "sender_name": f"LOWER(display_name) IN ({_in(fixed.IMPERSONAL_NAMES)})",
    "free_mail": "("
    + " OR ".join(f"REGEXP_MATCHES(address, '{p}', 'i')" for p in fixed.FREE_MAIL_PATTERNS)
    + ")",
}
_PARTS = f"(SELECT *, {_ADDRESS} AS address, {_NAME} AS display_name FROM f_emails) p"


def _register_rule(number: int, reason: str) -> None:
    @query(f"rul_{number}_{reason}", f"SELECT k, {_RULES[reason]} AS hit FROM {_PARTS}")
    def rule(t):
        return t.mails.select("k", rules.rule_flags(F.col("headers"))[reason].alias("hit"))


for _number, _reason in enumerate(rules.REASONS, start=1):
    _register_rule(_number, _reason)

_REASON = "CASE " + " ".join(f"WHEN {_RULES[r]} THEN '{r}'" for r in rules.REASONS) + " END"


@query("rul_7_reject_reason", f"SELECT k, {_REASON} AS reason FROM {_PARTS}")
def rul_7(t):
    return rules.with_reject_reason(t.mails).select("k", "reason")


@query("rul_7b_count_by_reason", f"""
SELECT COALESCE({_REASON}, '(passed)') AS reason, COUNT(*) AS n FROM {_PARTS} GROUP BY 1""")
def rul_7b(t):
    return mails.count_by_reason(t.mails)


@query("src_3_rule_list_hits", "SELECT * FROM (" + " UNION ALL ".join(
    [f"SELECT 'prefix' AS list, '{p}' AS entry, COUNT(*) AS n FROM {_PARTS} WHERE STARTS_WITH(address, '{p}')"
     for p in fixed.BLOCKED_PREFIXES]
    + [f"SELECT 'domain', '{d}', COUNT(*) FROM {_PARTS} WHERE CONTAINS(address, '@') AND CONTAINS(SPLIT_PART(address, '@', 2), '{d}')"
       for d in fixed.BLOCKED_DOMAIN_TOKENS]
    + [f"SELECT 'subject', '{s}', COUNT(*) FROM {_PARTS} WHERE CONTAINS(LOWER(subject_value), '{s}')"
       for s in fixed.AUTOMATED_SUBJECT_TERMS]) + ") h WHERE n > 0")
def src_3(t):
    return mails.rule_list_hits(t.mails)


# All eight lists, read from a JSON document that names some entries and leaves one list to its default.
_JSON_LISTS = {
    "blocked_prefixes": ["no-reply@", "info"],
    "blocked_domain_tokens": ["news.", "creator.com"],
    "bulk_headers": ["list-id"],
    "bulk_precedence_values": ["bulk"],
    "mailing_tools": ["mutt"],
    "automated_subject_terms": ["paid partnership", "hello"],
    "impersonal_names": ["ann lee", "digest"],
}
_PRECEDENCE = "TRIM(LOWER(COALESCE(precedence_value, '')))"
_LIST_TESTS = [
    *[("prefix", w, f"STARTS_WITH(address, '{w}')") for w in _JSON_LISTS["blocked_prefixes"]],
    *[("domain", w, f"CONTAINS(address, '@') AND CONTAINS(SPLIT_PART(address, '@', 2), '{w}')") for w in _JSON_LISTS["blocked_domain_tokens"]],
    *[("subject", w, f"CONTAINS(LOWER(subject_value), '{w}')") for w in _JSON_LISTS["automated_subject_terms"]],
    ("header", "list-id", "list_id_value IS NOT NULL"),
    ("precedence", "bulk", f"{_PRECEDENCE} = 'bulk'"),
    ("tool", "mutt", "CONTAINS(LOWER(x_mailer_value), 'mutt')"),
    *[("name", w, f"LOWER(display_name) = '{w}'") for w in _JSON_LISTS["impersonal_names"]],
    *[("free_mail", p, f"REGEXP_MATCHES(address, '(?i){p}')") for p in fixed.FREE_MAIL_PATTERNS],
]


@query("src_3b_rule_lists_from_json", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{kind}' AS list, '{entry}' AS entry, COUNT(*) AS n FROM {_PARTS} WHERE {test}" for kind, entry, test in _LIST_TESTS) + ") h WHERE n > 0")
def src_3_json(t):
    path = f"{shared_folder(t.spark)}/lists-{uuid.uuid4().hex}"
    t.spark.createDataFrame([(json.dumps(_JSON_LISTS),)], "value string").coalesce(1).write.text(path)
    return mails.rule_list_hits(t.mails, documents.read_rule_lists(t.spark, path), every_list=True)


# ---- filtering of state rows ----------------------------------------------------
_VERDICT = """CASE WHEN m.message_id IS NULL THEN NULL
 WHEN STARTS_WITH(LOWER(m.from_value), 'no-reply@') OR LOWER(m.from_value) LIKE '"the team"%'
  OR m.subject_value = 'Weekly Digest' THEN 'filter_rejected' ELSE 'pending_classification' END"""
_FILTERED = f"""SELECT s.*, {_VERDICT} AS verdict FROM f_deal_states s
 LEFT JOIN f_messages m ON m.message_id = s.message_id"""


@query("rul_8_filter_step", f"""
SELECT id, email_metadata_id, user_id, thread_id, message_id, sync_state_id,
 CASE WHEN status = 'filtering' AND verdict IS NOT NULL THEN verdict ELSE status END AS status, batch_id, created_at,
 CASE WHEN status = 'filtering' AND verdict IS NOT NULL THEN TIMESTAMP '2024-01-20 00:00:00' ELSE updated_at END AS updated_at
FROM ({_FILTERED}) x""")
def rul_8(t):
    return mails.filter_step(t.deal_states, t.state_mails, t.as_of)


@query("rul_8b_filter_counts", f"""
SELECT batch_id, COUNT(*) FILTER (WHERE verdict = 'pending_classification') AS passed,
 COUNT(*) FILTER (WHERE verdict = 'filter_rejected') AS rejected, COUNT(*) FILTER (WHERE verdict IS NULL) AS unfetched
FROM ({_FILTERED}) x WHERE status = 'filtering' GROUP BY batch_id""")
def rul_8b(t):
    return mails.filter_counts(t.deal_states, t.state_mails)


@query("src_2_header_only_messages", """
SELECT message_id, from_value AS sender, subject_value AS subject FROM f_emails""")
def src_2(t):
    h = F.col("headers")
    return mails.headers_only(t.mails).select(
        "message_id", hdr.header(h, "from").alias("sender"), hdr.header(h, "subject").alias("subject")
    )


@query("joi_13_enriched_messages", """
SELECT m.message_id, s.email_metadata_id AS id, s.thread_id, e.ai_summary AS previous_ai_summary
FROM f_messages m LEFT JOIN f_deal_states s ON s.message_id = m.message_id
LEFT JOIN f_evaluations e ON e.thread_id = s.thread_id""")
def joi_13(t):
    previous = t.evaluations.select("thread_id", F.col("ai_summary").alias("previous_ai_summary"))
    rows = t.deal_states.join(previous, "thread_id", "left")
    return mails.enrich(t.state_mails, rows).select("message_id", "id", "thread_id", "previous_ai_summary")


@query("agg_6_latest_mail_dates", f"""
SELECT thread_id, MAX({_DATE}) AS latest_mail_at FROM f_emails GROUP BY thread_id
HAVING MAX({_DATE}) IS NOT NULL""")
def agg_6(t):
    return mails.latest_mail_dates(t.mails)


# The message's own date: three of four can be read, whatever the header says.
@query("agg_6b_latest_own_dates", """
SELECT thread_id, MAX(CASE WHEN k % 4 <> 0 THEN sent_at END) AS latest_mail_at FROM f_emails GROUP BY thread_id
HAVING MAX(CASE WHEN k % 4 <> 0 THEN sent_at END) IS NOT NULL""")
def agg_6_own(t):
    own = F.when(F.col("k") % 4 != 0, F.col("sent_at").cast("string")).otherwise("soon")
    return mails.latest_mail_dates(t.mails.withColumn("date", own))


@query("joi_13b_mails_without_thread", """
SELECT m.message_id, COALESCE(CASE WHEN m.k % 3 <> 0 THEN m.thread_id END, m.message_id) AS thread_id FROM f_emails m""")
def joi_13_own(t):
    some = t.mails.withColumn("thread_id", F.when(F.col("k") % 3 == 1, F.col("thread_id")).when(F.col("k") % 3 == 2, F.col("thread_id")).otherwise(""))
    return mails.own_threads(some).select("message_id", "thread_id")


# ---- contacts ---------------------------------------------------------------------
_USABLE_SENDERS = f"""
SELECT * FROM (
 SELECT m.thread_id, m.user_id, m.received_at, m.id, LOWER(TRIM(s.sender_email)) AS email, TRIM(s.sender_name) AS name,
  LOWER(u.email) AS creator
 FROM f_email_metadata m JOIN f_senders s ON s.email_metadata_id = m.id
 LEFT JOIN f_user_settings u ON u.user_id = m.user_id) a
WHERE email <> '' AND (creator IS NULL OR email <> creator) AND NOT {blocked_sql('email')}"""
STORED_SENDERS = f"""
SELECT thread_id, user_id, email, NULLIF(name, '') AS name FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY thread_id, user_id ORDER BY received_at DESC, id DESC) AS rn
 FROM ({_USABLE_SENDERS}) s) r WHERE rn = 1"""


@query("joi_2_metadata_with_senders", """
SELECT m.thread_id, m.user_id, m.received_at, s.sender_email, s.sender_name
FROM f_email_metadata m JOIN f_senders s ON s.email_metadata_id = m.id""")
def joi_2(t):
    rows = t.email_metadata.withColumnRenamed("id", "email_metadata_id").join(t.senders, "email_metadata_id")
    return rows.select("thread_id", "user_id", "received_at", "sender_email", "sender_name")


@query("win_2_latest_stored_sender", STORED_SENDERS)
def win_2(t):
    return contacts.latest_stored_sender(t.email_metadata, t.senders, t.user_settings)


_HEADER_CANDIDATES = f"""
SELECT * FROM (SELECT thread_id, k, COALESCE({_DATE}, TIMESTAMP '1970-01-01 00:00:00') AS sent, {_ADDRESS} AS email,
 NULLIF({_NAME}, '') AS name, 'u' || user_id || '@creator.com' AS creator FROM f_emails) a
WHERE email <> '' AND email <> creator AND email <> 'me@creator.com' AND NOT {blocked_sql('email')}"""
HEADER_SENDERS = f"""
SELECT thread_id, email, name FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY thread_id ORDER BY sent DESC, k) AS rn FROM ({_HEADER_CANDIDATES}) c) r
WHERE rn = 1"""


@query("win_4_latest_header_sender", HEADER_SENDERS.replace("email <> creator AND ", ""))
def win_4(t):
    creators = t.mails.select("thread_id").distinct().withColumn("creator_email", F.lit("Me@creator.com "))
    return contacts.latest_header_sender(t.mails.withColumn("position", F.col("k")), creators)


@query("out_5_usable_contacts", f"""
SELECT batch_id, thread_index, LOWER(TRIM(contact_email)) AS email FROM f_replies
WHERE LOWER(TRIM(contact_email)) <> '' AND NOT {blocked_sql('LOWER(TRIM(contact_email))')}
 AND LOWER(TRIM(contact_email)) NOT LIKE 'u%@creator.com'""")
def out_5(t):
    email = F.lower(F.trim("contact_email"))
    creator = F.when(email.like("u%@creator.com"), email)
    return t.replies.filter(contacts.is_usable(F.col("contact_email"), creator)).select(
        "batch_id", "thread_index", email.alias("email")
    )
