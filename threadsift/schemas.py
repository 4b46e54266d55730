"""Declared schemas of every table; nothing is inferred on load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def _schema(ddl: str) -> str:
    """Schemas stay DDL text, which every reader takes; types need a session."""
    return ddl


def conform(rows: DataFrame, ddl: str) -> DataFrame:
    """Rows with exactly the declared columns and types; columns they lack are NULL."""
    from pyspark.sql import functions as F

    columns = []
    for field in StructType.fromDDL(ddl).fields:
        value = rows[field.name] if field.name in rows.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


STATES = _schema(
    "id STRING, email_metadata_id STRING, user_id STRING, thread_id STRING, message_id STRING, "
    "sync_state_id STRING, status STRING, batch_id STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
METADATA = _schema("id STRING, user_id STRING, thread_id STRING, message_id STRING, received_at TIMESTAMP")
SENDERS = _schema("email_metadata_id STRING, sender_email STRING, sender_name STRING")
BATCH_EVENTS = _schema(
    "trigger_hash STRING, batch_id STRING, batch_type STRING, event_type STRING, created_at TIMESTAMP"
)
AUDITS = _schema(
    "id STRING, batch_id STRING, thread_count BIGINT, email_count BIGINT, inference_cost DOUBLE, "
    "input_tokens BIGINT, output_tokens BIGINT, model_used STRING, ai_evaluation STRING, created_at TIMESTAMP"
)
EVALUATIONS = _schema(
    "id STRING, thread_id STRING, ai_evaluation_audit_id STRING, ai_insight STRING, ai_summary STRING, "
    "is_deal BOOLEAN, likely_scam BOOLEAN, ai_score INT, created_at TIMESTAMP, updated_at TIMESTAMP"
)
DEALS = _schema(
    "id STRING, user_id STRING, thread_id STRING, email_thread_evaluation_id STRING, deal_name STRING, "
    "deal_type STRING, category STRING, value DOUBLE, currency STRING, brand STRING, is_ai_sorted BOOLEAN, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
DEAL_CONTACTS = _schema(
    "deal_id STRING, user_id STRING, email STRING, contact_type STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
CONTACTS = _schema(
    "user_id STRING, email STRING, name STRING, company_name STRING, title STRING, phone_number STRING, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)
USER_SETTINGS = _schema("user_id STRING, email STRING")
SYNC_STATES = _schema("id STRING, user_id STRING, created_at TIMESTAMP, sync_strategy STRING")
SYNC_EVENTS = _schema("sync_state_id STRING, event STRING, created_at TIMESTAMP")
MARKERS = _schema("user_id STRING, integer_value STRING, double_value DOUBLE")
MESSAGES = _schema(
    "message_id STRING, id STRING, user_id STRING, thread_id STRING, previous_ai_summary STRING, "
    "headers ARRAY<STRUCT<name: STRING, value: STRING>>, body STRING, reply_body STRING, position BIGINT, date STRING"
)
REPLIES = _schema("run_id BIGINT, batch_id STRING, layer STRING, model STRING, raw STRING")
BATCH_ORDER = _schema("batch_id STRING, thread_index INT, thread_id STRING")
TRUTH = _schema(
    "id STRING, description STRING, "
    "emails ARRAY<STRUCT<messageId: STRING, id: STRING, threadId: STRING, previousAiSummary: STRING, "
    "topLevelHeaders: ARRAY<STRUCT<name: STRING, value: STRING>>, body: STRING, replyBody: STRING, date: STRING>>, "
    "expected STRUCT<is_deal: BOOLEAN, category: STRING, likely_scam: BOOLEAN, score_range: ARRAY<INT>>"
)
_STATS = "STRUCT<mean: DOUBLE, min: DOUBLE, max: DOUBLE, stddev: DOUBLE>"
EVAL_RESULT = _schema(
    "model STRING, runs BIGINT, successful_runs BIGINT, ground_truth_count BIGINT, "
    f"detection STRUCT<recall: {_STATS}, precision: {_STATS}, f2: {_STATS}>, "
    f"categorization STRUCT<accuracy: {_STATS}, per_category: MAP<STRING, "
    "STRUCT<mean: DOUBLE, min: DOUBLE, max: DOUBLE, stddev: DOUBLE, ground_truth_count: BIGINT>>>, "
    f"urgency_scoring STRUCT<in_range_rate: {_STATS}>, "
    f"scam_detection STRUCT<accuracy: {_STATS}, total_scam_threads: BIGINT>, "
    f"json_health STRUCT<clean_parse_rate: {_STATS}, repaired_rate: {_STATS}, corrective_retry_rate: {_STATS}, "
    "total_failures: BIGINT>, "
    "cost STRUCT<total_input_tokens: BIGINT, total_output_tokens: BIGINT, avg_cost_per_thread: DOUBLE>, "
    "per_thread ARRAY<STRUCT<id: STRING, expected: STRUCT<is_deal: BOOLEAN, category: STRING, likely_scam: BOOLEAN, "
    "score_range: ARRAY<INT>>, detection_correct: BIGINT, category_correct: BIGINT, score_in_range: BIGINT, "
    "scam_correct: BIGINT, total_runs: BIGINT>>"
)

# table name -> schema, in two namespaces as the jobs read them
DEAL_TABLES = {
    "deal_states": STATES,
    "batch_events": BATCH_EVENTS,
    "ai_evaluation_audits": AUDITS,
    "email_thread_evaluations": EVALUATIONS,
    "deals": DEALS,
    "deal_contacts": DEAL_CONTACTS,
    "user_sync_settings": USER_SETTINGS,
}
MAIL_TABLES = {
    "email_metadata": METADATA,
    "email_senders": SENDERS,
    "sync_states": SYNC_STATES,
    "sync_events": SYNC_EVENTS,
    "contacts": CONTACTS,
    "markers": MARKERS,
    "messages": MESSAGES,
}
