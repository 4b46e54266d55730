"""Message tables: enrichment, filtering and availability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.functions.headers import address, display_name, header, mail_date
from threadsift.functions.rules import DEFAULT_LISTS, RuleLists, reject_reason, with_reject_reason
from threadsift.functions.scalars import trim_blank
from threadsift.operators.mutations import apply_changes


def headers_only(messages: DataFrame) -> DataFrame:
    """Drop the bodies, so that a Parquet scan never reads them."""
    return messages.drop("body", "reply_body")


def claimed_messages(messages: DataFrame, rows: DataFrame) -> DataFrame:
    """The messages that the given rows name. No rule, body or header of another one is looked at."""
    return messages.join(rows.select("message_id"), "message_id", "left_semi")


def enrich(messages: DataFrame, rows: DataFrame) -> DataFrame:
    """Messages with the metadata id, thread and previous summary of their row.

    Messages without a row keep what they carry.
    """
    meta = rows.select(
        "message_id",
        F.col("email_metadata_id").alias("_id"),
        F.col("thread_id").alias("_thread_id"),
        (F.col("previous_ai_summary") if "previous_ai_summary" in rows.columns else F.lit(None).cast("string")).alias(
            "_summary"
        ),
    )
    joined = messages.join(meta, "message_id", "left")
    carried = {name: F.col(name) if name in messages.columns else F.lit(None).cast("string") for name in ("id", "thread_id", "previous_ai_summary")}
    return joined.withColumns(
        {
            "id": F.coalesce("_id", carried["id"]),
            "thread_id": F.coalesce("_thread_id", carried["thread_id"]),
            "previous_ai_summary": F.coalesce(F.nullif("_summary", F.lit("")), carried["previous_ai_summary"]),
        }
    ).drop("_id", "_thread_id", "_summary")


def count_by_reason(messages: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    reasons = with_reject_reason(headers_only(messages), lists)
    return reasons.groupBy(F.coalesce("reason", F.lit("(passed)")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def rule_list_hits(messages: DataFrame, lists: RuleLists = DEFAULT_LISTS, every_list: bool = False) -> DataFrame:
    """How many mails each single entry of the sender and subject lists matches, or of all eight lists."""

    def hits(kind: str, words, test) -> Column:
        entries = F.array(*[F.lit(w) for w in words])
        return F.transform(
            F.filter(entries, test), lambda w: F.struct(F.lit(kind).alias("list"), w.alias("entry"))
        )

    sender = header(F.col("headers"), "from")
    mails = messages.select(
        address(sender).alias("sender"),
        F.lower(header(F.col("headers"), "subject")).alias("subject"),
        F.lower(display_name(sender)).alias("name"),
        F.transform("headers", lambda h: F.lower(h["name"])).alias("names"),
        F.transform("headers", lambda h: F.lower(h["value"])).alias("values"),
        F.lower(header(F.col("headers"), "precedence")).alias("precedence"),
    )
    domain = F.when(F.col("sender").contains("@"), F.substring_index("sender", "@", -1)).otherwise("")
    found = F.concat(
        hits("prefix", lists.blocked_prefixes, lambda w: F.col("sender").startswith(w)),
        hits("domain", lists.blocked_domain_tokens, lambda w: domain.contains(w)),
        hits("subject", lists.automated_subject_terms, lambda w: F.col("subject").contains(w)),
    )
    if every_list:
        found = F.concat(
            found,
            hits("header", lists.bulk_headers, lambda w: F.array_contains("names", F.lower(w))),
            hits("precedence", lists.bulk_precedence_values, lambda w: F.trim("precedence") == w),
            hits("tool", lists.mailing_tools, lambda w: F.exists("values", lambda v: v.contains(F.lower(w)))),
            hits("name", lists.impersonal_names, lambda w: F.col("name") == F.lower(w)),
            hits("free_mail", lists.free_mail_patterns, lambda w: F.regexp_like("sender", F.concat(F.lit("(?i)"), w))),
        )
    return (
        mails.select(F.explode(found).alias("hit"))
        .groupBy("hit.list", "hit.entry")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def verdicts(messages: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """(message_id, verdict): the status a mail's rules lead to."""
    rejected = F.when(F.col("reason").isNotNull(), "filter_rejected").otherwise("pending_classification")
    return with_reject_reason(messages.select("message_id", "headers"), lists).select(
        "message_id", rejected.alias("verdict")
    )


def filter_changes(states: DataFrame, messages: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """New status of every row being filtered whose message is available.

    One exchange on message_id; rows without a message are left out and stay as they are.
    """
    waiting = states.filter(F.col("status") == "filtering").select("email_metadata_id", "batch_id", "message_id")
    judged = verdicts(claimed_messages(messages, waiting), lists)
    return waiting.join(judged, "message_id").withColumnRenamed("verdict", "status")


def filter_step(states: DataFrame, messages: DataFrame, as_of: Column, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    changes = filter_changes(states, messages, lists).select("email_metadata_id", "status")
    return apply_changes(states, changes, as_of)


def filter_counts(states: DataFrame, messages: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """passed / rejected / unfetched per batch."""
    changes = filter_changes(states, messages, lists).select(
        "email_metadata_id", F.col("status").alias("new_status")
    )
    waiting = states.filter(F.col("status") == "filtering").select("email_metadata_id", "batch_id")
    return (
        waiting.join(changes, "email_metadata_id", "left")
        .groupBy("batch_id")
        .agg(
            F.count_if(F.col("new_status") == "pending_classification").alias("passed"),
            F.count_if(F.col("new_status") == "filter_rejected").alias("rejected"),
            F.count_if(F.col("new_status").isNull()).alias("unfetched"),
        )
    )


def own_threads(messages: DataFrame) -> DataFrame:
    """Messages of which one without a thread id is a thread of its own, named by its id."""
    own = F.coalesce(*[F.nullif(name, F.lit("")) for name in ("thread_id", "id", "message_id") if name in messages.columns])
    return messages.withColumn("thread_id", own)


def date_text(messages: DataFrame) -> Column:
    """The message's own date; the Date header only in tables that do not store one."""
    return F.col("date") if "date" in messages.columns else header(F.col("headers"), "date")


def latest_mail_dates(messages: DataFrame, text: Column | None = None) -> DataFrame:
    """Latest readable mail date per thread; threads without one are left out."""
    text = date_text(messages) if text is None else text
    return (
        messages.filter(F.col("thread_id").isNotNull())
        .groupBy("thread_id")
        .agg(F.max(mail_date(text)).alias("latest_mail_at"))
        .filter(F.col("latest_mail_at").isNotNull())
    )


def usable_truth(truth: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """Labelled threads with `drop_reason`: 'empty_body', 'static_filter' or NULL (usable).

    A thread needs one mail with a body, and its first mail must pass the rules.
    """
    has_body = F.exists("emails", lambda e: F.coalesce(trim_blank(e["body"]) != "", F.lit(False)))
    rejected = reject_reason(F.get("emails", F.lit(0))["headers"], lists).isNotNull()
    return truth.withColumn(
        "drop_reason", F.when(~F.coalesce(has_body, F.lit(False)), "empty_body").when(rejected, "static_filter")
    )


def usable_truth_counts(truth: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    return usable_truth(truth, lists).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("drop_reason") == "empty_body").alias("empty_body"),
        F.count_if(F.col("drop_reason") == "static_filter").alias("static_filtered"),
        F.count_if(F.col("drop_reason").isNull()).alias("usable"),
    )
