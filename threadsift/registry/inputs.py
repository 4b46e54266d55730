"""Mail tables derived from the given Parquet tables, for checks and benches.

Each view is one portable SELECT. Spark builds it as a DataFrame; the DuckDB side
gets the same text as a CTE. All views grow with the tables they come from.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.session import configure

AS_OF = "2024-01-20 00:00:00"

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {}

VIEWS["f_email_metadata"] = """
SELECT 'em-' || CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS user_id,
 'th-' || CAST(o_custkey AS STRING) || '-' || CAST(CAST(FLOOR(o_orderkey / 7) AS BIGINT) % 3 AS STRING) AS thread_id,
 'msg-' || CAST(o_orderkey AS STRING) AS message_id, o_orderdate AS received_at
FROM orders"""

# Users divisible by three have every mail in a final state; elsewhere urgent
# open orders have no state row yet.
VIEWS["f_deal_states"] = """
SELECT 'ds-' || CAST(k AS STRING) AS id, 'em-' || CAST(k AS STRING) AS email_metadata_id,
 CAST(u AS STRING) AS user_id, 'th-' || CAST(u AS STRING) || '-' || CAST(CAST(FLOOR(k / 7) AS BIGINT) % 3 AS STRING) AS thread_id,
 'msg-' || CAST(k AS STRING) AS message_id,
 CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(u AS STRING) || '-' || CAST(k % 2 AS STRING) END AS sync_state_id,
 status,
 CASE WHEN status IN ('pending', 'pending_classification') OR k % 11 = 0 THEN NULL
  ELSE 'b-' || CAST(CAST(FLOOR(k / 12) AS BIGINT) AS STRING) END AS batch_id,
 TIMESTAMP '2024-01-01 00:00:00' AS created_at,
 TIMESTAMP '2024-01-20 00:00:00' - (k % 60) * INTERVAL '1' MINUTE AS updated_at
FROM (
 SELECT o_orderkey AS k, o_custkey AS u,
  CASE WHEN o_custkey % 3 = 0 THEN
    CASE o_orderkey % 5 WHEN 0 THEN 'deal' WHEN 1 THEN 'not_deal' WHEN 2 THEN 'filter_rejected'
     WHEN 3 THEN 'failed' ELSE 'dead' END
   WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL
   ELSE CASE o_orderkey % 9 WHEN 0 THEN 'pending' WHEN 1 THEN 'filtering' WHEN 2 THEN 'pending_classification'
     WHEN 3 THEN 'classifying' WHEN 4 THEN 'deal' WHEN 5 THEN 'not_deal' WHEN 6 THEN 'filter_rejected'
     WHEN 7 THEN 'failed' ELSE 'dead' END END AS status
 FROM orders) x
WHERE status IS NOT NULL"""

VIEWS["f_batch_events"] = """
SELECT 't-' || CAST(event_id AS STRING) AS trigger_hash,
 'b-' || CAST(CAST(FLOOR(event_id / 8) AS BIGINT) AS STRING) AS batch_id,
 CASE WHEN event_id % 2 = 0 THEN 'filter' ELSE 'classify' END AS batch_type,
 CASE WHEN event_type = 'view' THEN 'new' ELSE 'retrigger' END AS event_type, ts AS created_at
FROM events WHERE event_type IN ('click', 'view', 'error', 'purchase')"""

VIEWS["f_messages"] = """
SELECT 'msg-' || CAST(o_orderkey AS STRING) AS message_id, o_orderdate AS sent_at,
 CASE WHEN o_orderkey % 7 = 0 THEN 'not a date' ELSE CAST(o_orderdate AS STRING) END AS date_text,
 CASE o_orderkey % 10 WHEN 0 THEN 'No-Reply@brand.com' WHEN 1 THEN '"The Team" <x@brand.com>'
  WHEN 2 THEN 'u' || CAST(o_custkey AS STRING) || '@creator.com' ELSE 'Bo <bo@agency.co>' END AS from_value,
 CASE o_orderkey % 8 WHEN 0 THEN 'Weekly Digest' ELSE 'Paid partnership' END AS subject_value
FROM orders WHERE o_orderpriority <> '5-LOW'"""

VIEWS["f_evaluations"] = """
SELECT thread_id, COUNT(*) % 2 = 0 AS is_deal, 'sum-' || thread_id AS ai_summary FROM (
 SELECT 'th-' || CAST(o_custkey AS STRING) || '-' || CAST(CAST(FLOOR(o_orderkey / 7) AS BIGINT) % 3 AS STRING) AS thread_id
 FROM orders WHERE o_orderstatus = 'F') x
GROUP BY thread_id"""

VIEWS["f_user_settings"] = """
SELECT CAST(c_custkey AS STRING) AS user_id, 'u' || CAST(c_custkey AS STRING) || '@creator.com' AS email
FROM customer WHERE c_nationkey <> 9"""

VIEWS["f_senders"] = """
SELECT 'em-' || CAST(o_orderkey AS STRING) AS email_metadata_id,
 CASE o_orderkey % 6 WHEN 0 THEN 'no-reply@brand.com'
  WHEN 1 THEN 'u' || CAST(o_custkey AS STRING) || '@creator.com' WHEN 2 THEN ''
  WHEN 3 THEN ' Ann' || CAST(o_orderkey % 9 AS STRING) || '@Brand.com ' WHEN 4 THEN 'bo@news.brand.com'
  ELSE 'cy@agency.co' END AS sender_email,
 CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Name ' || CAST(o_orderkey % 9 AS STRING) END AS sender_name
FROM orders"""

VIEWS["f_deals"] = """
SELECT thread_id AS id, MIN(user_id) AS user_id, thread_id,
 CASE COUNT(*) % 6 WHEN 0 THEN 'new' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'completed'
  WHEN 3 THEN 'not_interested' WHEN 4 THEN 'likely_scam' ELSE 'low_confidence' END AS category,
 TIMESTAMP '2024-01-12 00:00:00' + (MIN(CAST(SUBSTR(email_metadata_id, 4) AS BIGINT)) % 30) * INTERVAL '1' DAY AS updated_at
FROM f_deal_states WHERE status = 'deal' GROUP BY thread_id"""

VIEWS["f_deal_contacts"] = """
SELECT id AS deal_id, user_id,
 'c' || SUBSTR(id, LENGTH(id), 1) || '@brand' || SUBSTR(user_id, LENGTH(user_id), 1) || '.com' AS email,
 'primary' AS contact_type FROM f_deals"""

VIEWS["f_contacts"] = """
SELECT DISTINCT user_id, email, CAST(NULL AS STRING) AS name FROM f_deal_contacts WHERE email NOT LIKE 'c2@%'"""

VIEWS["f_sync_states"] = """
SELECT CAST(event_id AS STRING) AS id, CAST(user_id AS STRING) AS user_id, ts AS created_at,
 CASE WHEN user_id % 5 = 0 AND event_id % 2 = 0 THEN 'FORWARD' ELSE 'LOOKBACK' END AS sync_strategy, value
FROM events WHERE event_type = 'signup'"""

VIEWS["f_sync_events"] = """
SELECT id AS sync_state_id, 'metadata_ingestion_end' AS event, created_at + INTERVAL '1' HOUR AS created_at
FROM f_sync_states WHERE value > 80
UNION ALL SELECT id, 'metadata_ingestion_failed', created_at + INTERVAL '2' HOUR FROM f_sync_states WHERE value > 110
UNION ALL SELECT id, 'completed', created_at + INTERVAL '3' HOUR FROM f_sync_states WHERE value > 160"""

VIEWS["f_markers"] = """
SELECT CAST(c_custkey AS STRING) AS user_id,
 CASE c_custkey % 4 WHEN 0 THEN '1710000000' WHEN 1 THEN '0' WHEN 2 THEN 'not-a-timestamp' END AS integer_value,
 CASE WHEN c_custkey % 4 = 3 THEN CAST(1710000000 - (c_custkey % 8) * 500000000 AS DOUBLE) END AS double_value
FROM customer WHERE c_nationkey < 20"""

VIEWS["f_lookback_attempts"] = """
SELECT event_id, CAST(user_id AS STRING) AS user_id,
 CASE event_id % 4 WHEN 0 THEN '60' WHEN 1 THEN ' 45 ' WHEN 2 THEN '60days' ELSE NULL END AS days_text,
 event_type = 'purchase' AS sync_complete, event_type = 'error' AND event_id % 2 = 0 AS quota,
 event_type = 'error' AS rate_limited, event_type = 'click' AND event_id % 3 = 0 AS batch_blocked,
 CAST(FLOOR(value * 1000) AS BIGINT) AS elapsed_ms,
 CASE WHEN event_id % 5 <> 0 THEN 10000 * (event_id % 3) END AS budget_ms, ts FROM events"""

VIEWS["f_emails"] = """
SELECT 'm-' || CAST(doc_id AS STRING) AS message_id, doc_id AS k, CAST(CAST(FLOOR(doc_id / 8) AS BIGINT) AS STRING) AS user_id,
 'th-' || CAST(CAST(FLOOR(doc_id / 4) AS BIGINT) AS STRING) AS thread_id,
 TIMESTAMP '2024-01-01 00:00:00' + (doc_id % 700) * INTERVAL '1' HOUR AS sent_at,
 CASE doc_id % 12 WHEN 0 THEN 'Ann Lee <ann@brand.com>' WHEN 1 THEN 'No-Reply@brand.com'
  WHEN 2 THEN '"The Team" <x@brand.com>' WHEN 3 THEN 'Bo <bo@news.brand.com>' WHEN 4 THEN 'info12@gmail.com'
  WHEN 5 THEN 'me@creator.com' WHEN 6 THEN '"Cy Poe" <CY@Agency.co>' WHEN 7 THEN 'promo9@yahoo.net'
  WHEN 8 THEN 'Digest <d@brand.com>' WHEN 9 THEN 'ev@agency.gov' WHEN 10 THEN '' ELSE 'fay@studio.tv' END AS from_value,
 CASE doc_id % 7 WHEN 0 THEN 'Weekly Digest' WHEN 1 THEN 'Paid partnership' WHEN 2 THEN 'PROMOTION inside'
  ELSE 'Hello ' || source END AS subject_value,
 CASE doc_id % 5 WHEN 0 THEN 'dkim=fail spf=fail' WHEN 1 THEN NULL ELSE 'dkim=pass spf=none' END AS auth_value,
 CASE WHEN doc_id % 17 = 0 THEN '<list.brand.com>' END AS list_id_value,
 CASE WHEN doc_id % 19 = 0 THEN 'bulk' END AS precedence_value,
 CASE WHEN doc_id % 23 = 0 THEN 'MailChimp Mailer' ELSE 'Mutt' END AS x_mailer_value,
 CASE WHEN doc_id % 9 = 0 THEN 'not a date' WHEN doc_id % 9 = 1 THEN NULL
  WHEN doc_id % 9 < 5 THEN CAST(TIMESTAMP '2024-01-01 00:00:00' + (doc_id % 700) * INTERVAL '1' HOUR AS STRING)
  ELSE 'Mon, ' || CAST(1 + CAST(FLOOR((doc_id % 700) / 24) AS BIGINT) AS STRING) || ' Jan 2024 '
   || LPAD(CAST(doc_id % 700 % 24 AS STRING), 2, '0') || ':00:00 +0000' END AS date_value,
 text AS body FROM documents"""

VIEWS["f_truth"] = """
SELECT doc_id AS id, quality = 1 AS is_deal, toxic = 1 AS likely_scam,
 CASE WHEN quality = 1 THEN CASE doc_id % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'completed'
  ELSE 'low_confidence' END END AS category,
 CASE WHEN doc_id % 10 <> 9 THEN 1 + doc_id % 5 END AS score_lo,
 CASE WHEN doc_id % 10 <> 9 THEN 4 + doc_id % 5 END AS score_hi FROM labels"""

# Five model runs over the truth set; some threads get no answer, some get two.
VIEWS["f_predictions"] = """
SELECT run_id, thread_id, pos,
 CASE WHEN (thread_id * 7 + run_id * 3 + pos) % 10 = 0 THEN NOT is_deal ELSE is_deal END AS is_deal,
 CASE WHEN (thread_id + run_id) % 6 = 0 THEN 'new' ELSE category END AS category,
 CASE WHEN (thread_id + run_id + pos) % 8 = 0 THEN NOT likely_scam ELSE likely_scam END AS likely_scam,
 1 + (thread_id * 3 + run_id) % 10 AS ai_score
FROM (SELECT run_id, id AS thread_id, is_deal, category, likely_scam, EXPLODE_ONE_TWO AS pos
 FROM (SELECT id, is_deal, category, likely_scam, EXPLODE_RUNS AS run_id FROM f_truth) r) p
WHERE (pos = 1 AND NOT (likely_scam AND run_id = 2)) OR (pos = 2 AND likely_scam AND run_id = 4)"""

VIEWS["f_replies"] = """
SELECT CAST(FLOOR(doc_id / 5) AS BIGINT) AS batch_id, doc_id % 5 + 1 AS thread_index,
 'th-' || CAST(doc_id AS STRING) AS thread_id,
 CASE WHEN FLOOR(doc_id / 5) % 4 = 0 THEN 'fenced' WHEN FLOOR(doc_id / 5) % 4 = 1 THEN 'wrapped'
  WHEN FLOOR(doc_id / 5) % 4 = 2 THEN 'prose' ELSE 'broken' END AS shape,
 doc_id % 3 <> 0 AS is_deal, doc_id % 14 AS ai_score,
 CASE doc_id % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'weird' WHEN 2 THEN 'likely_scam' ELSE 'completed' END AS category,
 CASE doc_id % 5 WHEN 0 THEN 'sponsorship' WHEN 1 THEN 'odd' ELSE 'affiliate' END AS deal_type,
 CASE WHEN doc_id % 6 = 0 THEN NULL ELSE doc_id * 10 END AS deal_value,
 CASE doc_id % 7 WHEN 0 THEN 'no-reply@brand.com' WHEN 1 THEN '' WHEN 2 THEN 'u' || CAST(CAST(FLOOR(doc_id / 8) AS BIGINT) AS STRING) || '@creator.com'
  ELSE ' Pat' || CAST(doc_id % 50 AS STRING) || '@Brand.com' END AS contact_email,
 CASE WHEN doc_id % 8 = 0 THEN '' ELSE 'Pat ' || source END AS contact_name,
 lang, text AS ai_summary FROM documents"""

# Same text for both engines apart from the two ways to spell "one row per run".
_SPARK_WORDS = {
    "EXPLODE_RUNS": "explode(array(1, 2, 3, 4, 5))",
    "EXPLODE_ONE_TWO": "explode(array(1, 2))",
}
_DUCKDB_WORDS = {
    "EXPLODE_RUNS": "unnest([1, 2, 3, 4, 5])",
    "EXPLODE_ONE_TWO": "unnest([1, 2])",
}

_REFERENCE = re.compile(r"\b(FROM|JOIN)\s+(\w+)")
_VIEW_NAME = re.compile(r"\bf_\w+")


def _words(text: str, table: dict[str, str]) -> str:
    for word, replacement in table.items():
        text = text.replace(word, replacement)
    return text


def oracle_text(sql: str) -> str:
    """Prefix a DuckDB statement with the CTEs of the views it names."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name not in VIEWS:
            return
        for dependency in _VIEW_NAME.findall(VIEWS[name]):
            visit(dependency)
        order.append(name)

    for name in _VIEW_NAME.findall(sql):
        visit(name)
    ctes = [f"{name} AS ({_words(VIEWS[name], _DUCKDB_WORDS).strip()})" for name in order]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join([*ctes, body[5:]])
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


class Inputs:
    """Lazily built DataFrames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    @property
    def as_of(self) -> Column:
        return F.lit(AS_OF).cast("timestamp")

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = _words(VIEWS[name], _SPARK_WORDS)
        named = {ref for _, ref in _REFERENCE.findall(text)}
        text = _REFERENCE.sub(r"\1 {\2}", text)
        return self.spark.sql(text, **{ref: self.frame(ref) for ref in named})

    def metadata_from(self, orders: DataFrame) -> DataFrame:
        """`f_email_metadata` over another (also streaming) orders frame."""
        return self.spark.sql(_REFERENCE.sub(r"\1 {\2}", VIEWS["f_email_metadata"]), orders=orders)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.frame(name if name in BASE_TABLES else f"f_{name}")

    @cached_property
    def mails(self) -> DataFrame:
        """`f_emails` in message shape: headers as an array, body, ids."""
        pairs = {
            "From": "from_value",
            "Subject": "subject_value",
            "Authentication-Results": "auth_value",
            "List-Id": "list_id_value",
            "Precedence": "precedence_value",
            "X-Mailer": "x_mailer_value",
            "Date": "date_value",
        }
        return self.frame("f_emails").select(
            "message_id", "k", "user_id", "thread_id", "sent_at", header_array(pairs), "body"
        )

    @cached_property
    def state_mails(self) -> DataFrame:
        """`f_messages` in message shape (headers only)."""
        pairs = {"From": "from_value", "Subject": "subject_value", "Date": "date_text"}
        return self.frame("f_messages").select("message_id", "sent_at", header_array(pairs))


def header_array(pairs: dict[str, str]) -> Column:
    entries = [
        F.when(F.col(column).isNotNull(), F.struct(F.lit(name).alias("name"), F.col(column).alias("value")))
        for name, column in pairs.items()
    ]
    return F.array_compact(F.array(*entries)).alias("headers")
