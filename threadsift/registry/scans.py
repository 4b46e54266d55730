"""First scans, notifications, look-back windows and the sync stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadsift.operators import eligibility as eli
from threadsift.operators import lookback, notifications
from threadsift.registry import query
from threadsift.session import shared_folder
from threadsift.streaming import sync as stream

CATEGORIES = ("new", "in_progress", "completed", "not_interested", "likely_scam", "low_confidence")
ACTIVE = "('pending', 'filtering', 'pending_classification', 'classifying')"

_LATEST = """SELECT newest.id AS sync_state_id, user_id, newest.created_at AS created_at, newest.strategy AS sync_strategy
FROM (SELECT user_id, MAX({'created_at': created_at, 'id': id, 'strategy': sync_strategy}) AS newest FROM f_sync_states GROUP BY user_id) u"""


@query("win_1_latest_sync", _LATEST)
def win_1(t):
    return eli.latest_sync(t.sync_states)


# Mails and finished mails are counted once for each user and then looked up.
_STATUS = f"""SELECT l.user_id, l.sync_state_id, l.created_at AS initiated_at, COALESCE(mails.n, 0) AS total_messages,
 COALESCE(done.n, 0) AS processed_messages
FROM ({_LATEST}) l
LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM f_email_metadata GROUP BY user_id) mails ON mails.user_id = l.user_id
LEFT JOIN (SELECT user_id, COUNT(status) - COUNT(*) FILTER (WHERE status IN {ACTIVE}) AS n FROM f_deal_states GROUP BY user_id) done
 ON done.user_id = l.user_id
WHERE l.sync_strategy = 'LOOKBACK'"""


@query("joi_12_message_counts_per_user", _STATUS)
def joi_12(t):
    return eli.sync_progress(eli.latest_sync(t.sync_states), t.email_metadata, t.deal_states)


_SUCCESS_EVENTS = "('metadata_ingestion_end', 'content_ingestion_end', 'completed')"
# A sync succeeded if its last success is not older than its last failure.
_PRIOR = f"""SELECT ss.id, ss.user_id, ss.created_at FROM f_sync_states ss JOIN (
 SELECT sync_state_id, MAX(created_at) FILTER (WHERE event IN {_SUCCESS_EVENTS}) AS won,
  MAX(created_at) FILTER (WHERE event LIKE '%_ingestion_failed') AS lost FROM f_sync_events GROUP BY sync_state_id) log
 ON log.sync_state_id = ss.id
WHERE ss.sync_strategy = 'LOOKBACK' AND won >= COALESCE(lost, won)"""


@query("joi_7_successful_lookbacks", _PRIOR)
def joi_7(t):
    return eli.successful_lookbacks(t.sync_states, t.sync_events)


# The first success of each user decides: nothing may have succeeded before the scan began.
_FIRST = f"SELECT user_id, MIN(created_at) AS first_success FROM ({_PRIOR}) p GROUP BY user_id"
_UNTOLD = f"""SELECT s.* FROM ({_STATUS}) s LEFT JOIN ({_FIRST}) f ON f.user_id = s.user_id
WHERE COALESCE(first_success >= initiated_at, TRUE)"""
_ELIGIBLE = f"SELECT * FROM ({_UNTOLD}) u WHERE total_messages BETWEEN 1 AND processed_messages AND initiated_at IS NOT NULL"


@query("joi_8_without_earlier_success", f"SELECT user_id, initiated_at FROM ({_UNTOLD}) u")
def joi_8(t):
    users = eli.sync_progress(eli.latest_sync(t.sync_states), t.email_metadata, t.deal_states)
    return eli.without_earlier_success(users, eli.successful_lookbacks(t.sync_states, t.sync_events)).select(
        "user_id", "initiated_at"
    )


def _all_users(t):
    return eli.latest_sync(t.sync_states).withColumnRenamed("created_at", "initiated_at")


def _deal_counts(users: str) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE category = '{c}') AS db_{c}" for c in CATEGORIES)
    found = ", ".join(f"COALESCE(db_{c}, 0) AS db_{c}" for c in CATEGORIES)
    return f"""SELECT u.user_id, {found} FROM ({users}) u LEFT JOIN (
 SELECT d.user_id, {counts} FROM f_deals d, ({users}) w WHERE w.user_id = d.user_id AND d.updated_at >= w.initiated_at
 GROUP BY d.user_id) n ON n.user_id = u.user_id"""


def _contact_counts(users: str) -> str:
    return f"""SELECT user_id, COUNT(*) AS contacts_added FROM (
 SELECT user_id, email FROM f_deal_contacts WHERE (deal_id, user_id) IN (
  SELECT (d.id, d.user_id) FROM f_deals d, ({users}) w WHERE w.user_id = d.user_id AND d.updated_at >= w.initiated_at)
 INTERSECT SELECT user_id, email FROM f_contacts) x GROUP BY user_id"""


_USERS = f"SELECT user_id, created_at AS initiated_at FROM ({_LATEST}) l"


@query("joi_9_deal_counts_since_start", _deal_counts(_USERS))
def joi_9(t):
    return eli.deal_counts(_all_users(t), t.deals)


@query("agg_4_deals_per_category", f"""
SELECT {', '.join(f"COUNT(*) FILTER (WHERE category = '{c}') AS db_{c}" for c in CATEGORIES)} FROM f_deals""")
def agg_4(t):
    return t.deals.agg(*eli.category_counts())


@query("joi_10_contact_counts_since_start", _contact_counts(_USERS))
def joi_10(t):
    return eli.contact_counts(_all_users(t), t.deal_contacts, t.deals, t.contacts)


@query("agg_5_contacts_per_user", "SELECT user_id, COUNT(DISTINCT email) AS contacts FROM f_deal_contacts GROUP BY user_id")
def agg_5(t):
    return eli.contacts_per_user(t.deal_contacts)


def _report(limit: int | None = None) -> str:
    counts = ", ".join(f"db_{c}" for c in CATEGORIES)
    first = f" ORDER BY initiated_at, user_id LIMIT {limit}" if limit else ""
    return f"""SELECT u.user_id, u.initiated_at, {counts}, COALESCE(contacts_added, 0) AS contacts_added FROM ({_ELIGIBLE}) u
JOIN ({_deal_counts(_ELIGIBLE)}) n USING (user_id) LEFT JOIN ({_contact_counts(_ELIGIBLE)}) c USING (user_id){first}"""


def report(t, limit: int | None = None):
    return eli.eligible_report(
        t.sync_states, t.sync_events, t.email_metadata, t.deal_states, t.deals, t.deal_contacts, t.contacts, limit
    )


@query("eli_1_eligible_users", _report())
def eli_1(t):
    return report(t)


@query("joi_11_report_of_all_eligible_users", _report())
def joi_11(t):
    return report(t)


@query("srt_1_first_five_eligible_users", _report(5))
def srt_1(t):
    return report(t, 5)


_MARKED = """SELECT user_id, CASE WHEN integer_value IS NOT NULL AND integer_value <> ''
 THEN COALESCE(REGEXP_MATCHES(integer_value, '^-?[0-9]+$') AND TRY_CAST(integer_value AS DOUBLE) > 0, FALSE)
 ELSE COALESCE(double_value > 0, FALSE) END AS sent FROM f_markers"""


@query("src_6_valid_markers", _MARKED)
def src_6(t):
    return t.markers.select(
        "user_id", notifications.is_sent(F.col("integer_value"), F.col("double_value")).alias("sent")
    )


_WAITING = f"SELECT r.* FROM ({_report()}) r WHERE r.user_id NOT IN (SELECT user_id FROM ({_MARKED}) m WHERE sent)"


@query("joi_18_not_yet_notified", f"SELECT user_id, initiated_at FROM ({_WAITING}) w")
def joi_18(t):
    rows = notifications.classify(report(t), t.markers)
    return rows.filter(F.col("outcome") == "to_send").select("user_id", "initiated_at")


def _payload(source: str) -> str:
    parts = (
        ("new", "new"), ("inProgress", "in_progress"), ("completed", "completed"),
        ("likelyScam", "likely_scam"), ("lowConfidence", "low_confidence"), ("notInterested", "not_interested"),
    )
    counts = " || ',' || ".join(f"""'"{name}":' || CAST(db_{column} AS STRING)""" for name, column in parts)
    return f"""SELECT user_id, '{{"userId":"' || user_id || '","eventType":"scan_complete","eventData":{{"dealCounts":{{'
 || {counts} || '}},"contactsAdded":' || CAST(contacts_added AS STRING) || '}}}}' AS payload FROM ({source}) w"""


@query("snk_5_outbox", _payload(_WAITING))
def snk_5(t):
    return notifications.outbox(report(t), t.markers)


_ROWS = f"""SELECT CASE WHEN user_id LIKE '%7' THEN '  ' ELSE user_id END AS user_id, * EXCLUDE (user_id)
FROM ({_report()}) r"""


def damaged_report(t):
    """The report with some user ids lost and upper-case column names."""
    rows = report(t).withColumn(
        "user_id", F.when(F.col("user_id").endswith("7"), "  ").otherwise(F.col("user_id"))
    )
    return rows.toDF(*[name.upper() for name in rows.columns])


@query("eli_2_rows_without_user", f"SELECT COUNT(*) AS n, COUNT(DISTINCT initiated_at) AS starts FROM ({_ROWS}) r WHERE TRIM(user_id) = ''")
def eli_2(t):
    return notifications.quarantined(damaged_report(t)).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("initiated_at").alias("starts")
    )


@query("eli_3_notification_summary", f"""
SELECT COUNT(*) AS scanned, COUNT(*) FILTER (WHERE TRIM(user_id) <> '' AND user_id IN (SELECT user_id FROM ({_MARKED}) m WHERE sent)) AS skipped,
 COUNT(*) FILTER (WHERE TRIM(user_id) <> '' AND user_id NOT IN (SELECT user_id FROM ({_MARKED}) m WHERE sent)) AS to_send,
 COUNT(*) FILTER (WHERE TRIM(user_id) = '') AS errors FROM ({_ROWS}) r""")
def eli_3(t):
    return notifications.summary(damaged_report(t), t.markers)


_SYNC_STATUS = f"""
SELECT l.user_id, l.sync_state_id AS sync_id, l.created_at AS initiated_at, COALESCE(m.n, 0) AS total_messages,
 COALESCE(s.prepped, 0) AS prepped_messages, COALESCE(s.processed, 0) AS processed_messages, s.completed_at,
 {', '.join(f'd.db_{c}' for c in CATEGORIES)}, COALESCE(c.contacts_added, 0) AS identified_contacts_count
FROM ({_LATEST}) l LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM f_email_metadata GROUP BY user_id) m ON m.user_id = l.user_id
LEFT JOIN (SELECT user_id, COUNT(*) AS prepped, COUNT(*) FILTER (WHERE status NOT IN {ACTIVE}) AS processed,
 MAX(CASE WHEN status NOT IN {ACTIVE} THEN updated_at END) AS completed_at FROM f_deal_states GROUP BY user_id) s ON s.user_id = l.user_id
LEFT JOIN ({_deal_counts(_USERS)}) d ON d.user_id = l.user_id LEFT JOIN ({_contact_counts(_USERS)}) c ON c.user_id = l.user_id"""


@query("eli_4_sync_status", _SYNC_STATUS)
def eli_4(t):
    return eli.sync_status(
        t.sync_states, t.email_metadata, t.deal_states, t.deals, t.deal_contacts, t.contacts
    )


@query("joi_19_completion_times", f"SELECT user_id, processed_messages, completed_at FROM ({_SYNC_STATUS}) s")
def joi_19(t):
    return eli_4(t).select("user_id", "processed_messages", "completed_at")


# ---- look-back windows ----------------------------------------------------------------
_DAYS = """CASE WHEN TRIM(days_text) = '60' THEN 60 WHEN TRIM(days_text) = '45' THEN 45 ELSE 60 END"""


@query("lbk_1_lookback_days", f"SELECT event_id, CAST({_DAYS} AS INTEGER) AS days FROM f_lookback_attempts")
def lbk_1(t):
    return t.lookback_attempts.select("event_id", lookback.lookback_days(F.col("days_text")).alias("days"))


@query("lbk_2_mails_in_window", """
SELECT id, received_at FROM f_email_metadata
WHERE received_at >= TIMESTAMP '2001-08-01 00:00:00' - 60 * INTERVAL '24' HOUR AND received_at <= TIMESTAMP '2001-08-01 00:00:00'""")
def lbk_2(t):
    end = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    return lookback.in_window(t.email_metadata, end, F.lit(60)).select("id", "received_at")


@query("lbk_2b_window_of_each_attempt", f"""
SELECT event_id, ts AS range_end, ts - ({_DAYS}) * INTERVAL '24' HOUR AS range_start FROM f_lookback_attempts""")
def lbk_2b(t):
    days = lookback.lookback_days(F.col("days_text"))
    return t.lookback_attempts.select(
        "event_id", F.col("ts").alias("range_end"), lookback.range_start(F.col("ts"), days).alias("range_start")
    )


_REASON = f"""CASE WHEN {_DAYS} <> 60 OR sync_complete THEN NULL WHEN quota THEN 'gmail_quota'
 WHEN rate_limited THEN 'gmail_rate_limit' WHEN batch_blocked THEN 'batch_processing_constraint'
 WHEN budget_ms > 0 AND elapsed_ms >= budget_ms THEN 'operational_window_exceeded' END"""


def reasons(t):
    attempts = t.lookback_attempts.withColumn("days_requested", lookback.lookback_days(F.col("days_text")))
    return lookback.fallback_reason(attempts)


@query("lbk_3_fallback_reasons", f"SELECT event_id, {_REASON} AS reason FROM f_lookback_attempts")
def lbk_3(t):
    return reasons(t).select("event_id", "reason")


@query("lbk_4_fallback_log", f"""
SELECT user_id, '{{"event":"uei_lookback_fallback","userId":"' || user_id || '","fellBackTo":45,"reason":"' || reason || '"}}' AS line
FROM (SELECT user_id, {_REASON} AS reason FROM f_lookback_attempts) r WHERE reason IS NOT NULL""")
def lbk_4(t):
    return lookback.fallback_log(reasons(t))


@query("lbk_4b_fallback_rate", f"""
SELECT COUNT(*) AS attempts, COUNT(reason) AS fallbacks, ROUND(CAST(COUNT(reason) AS DOUBLE) / COUNT(*), 4) AS rate,
 CAST(COUNT(reason) AS DOUBLE) / COUNT(*) <= 0.1 AS within_guard
FROM (SELECT {_DAYS} AS days, {_REASON} AS reason FROM f_lookback_attempts) r WHERE days = 60""")
def lbk_4b(t):
    return lookback.fallback_rate(reasons(t))


# ---- stream ---------------------------------------------------------------------------
@query("str_1_stream_sync", """
SELECT s.email_metadata_id, s.user_id, s.status FROM f_deal_states s
UNION ALL SELECT m.id, m.user_id, 'pending' FROM f_email_metadata m
WHERE NOT EXISTS (SELECT 1 FROM f_deal_states s WHERE s.email_metadata_id = m.id)""")
def str_1(t):
    """Run the stream to its end over the orders table, then read the state table back."""
    folder = f"{shared_folder(t.spark)}/sync-{uuid.uuid4().hex}"
    states_path, checkpoint = f"{folder}/states", f"{folder}/checkpoint"
    stream.prepare_states(t.deal_states, states_path)
    orders = t.spark.readStream.schema(t.orders.schema).option("pathGlobFilter", "orders.parquet").parquet(t.sf_dir)
    arriving = t.metadata_from(orders)
    stream.start_sync(arriving, states_path, checkpoint, t.as_of).awaitTermination()
    return stream.read_states(t.spark, states_path).select("email_metadata_id", "user_id", "status")
