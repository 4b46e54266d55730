"""From classified threads to evaluations, deals, contacts, audits and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.rules import DEFAULT_LISTS, RuleLists
from threadsift.functions.scalars import nullable_text, stable_id, straight_quotes, straight_quotes_in_json
from threadsift.operators.contacts import is_usable, normal_address
from threadsift.operators.mutations import last_write


def already_evaluated(latest_mail_dates: DataFrame, deals: DataFrame) -> DataFrame:
    """Threads that keep their deal: no mail is newer than the deal's last update."""
    known = deals.select("thread_id", F.col("updated_at").alias("deal_updated_at"))
    return (
        latest_mail_dates.join(known, "thread_id")
        .filter(F.col("latest_mail_at") <= F.col("deal_updated_at"))
        .select("thread_id")
    )


def unavailable_threads(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """Threads of the given rows of which no message can be read.

    The rows shrink to one flag per thread before anything is collected.
    """
    present = messages.select("message_id", F.lit(True).alias("_present"))
    return (
        rows.select("thread_id", "message_id")
        .join(present, "message_id", "left")
        .groupBy("thread_id")
        .agg(F.bool_or(F.col("_present").isNotNull()).alias("any_message"))
        .filter(~F.col("any_message"))
        .select("thread_id")
    )


def thread_verdicts(threads: DataFrame) -> DataFrame:
    """(thread_id, is_deal) per thread; of contradicting items the negative one counts."""
    return (
        threads.filter(F.coalesce(F.col("thread_id"), F.lit("")) != "")
        .groupBy("thread_id")
        .agg(F.bool_and("is_deal").alias("is_deal"))
    )


def terminal_changes(
    rows: DataFrame, threads: DataFrame, skipped: DataFrame, previous: DataFrame
) -> DataFrame:
    """Final status of every claimed row.

    A thread in the reply follows its verdict; a skipped thread stays a deal; any
    other thread follows its previous evaluation, and without one is no deal.
    """
    verdicts = thread_verdicts(threads).select("thread_id", F.col("is_deal").alias("_verdict"))
    kept = skipped.select("thread_id").distinct().withColumn("_kept", F.lit(True))
    before = previous.select("thread_id", (F.lower(F.col("is_deal").cast("string")) == "true").alias("_before"))
    return (
        rows.select("email_metadata_id", "thread_id")
        .join(verdicts, "thread_id", "left")
        .join(kept, "thread_id", "left")
        .join(before, "thread_id", "left")
        .select(
            "email_metadata_id",
            F.when(F.col("_verdict").isNotNull(), F.when(F.col("_verdict"), "deal").otherwise("not_deal"))
            .when(F.col("_kept"), "deal")
            .when(F.col("_before"), "deal")
            .otherwise("not_deal")
            .alias("status"),
        )
    )


def evaluation_rows(threads: DataFrame, as_of: Column) -> DataFrame:
    """Rows for the evaluations table; the insight column holds the category."""
    category = F.coalesce("category", F.lit(""))
    rows = threads.select(
        stable_id(F.lit("evaluation"), F.col("thread_id")).alias("id"),
        "thread_id",
        F.lit("").alias("ai_evaluation_audit_id"),
        straight_quotes(category).alias("ai_insight"),
        straight_quotes(F.col("ai_summary")).alias("ai_summary"),
        "is_deal",
        (F.lower(category) == fixed.SCAM_CATEGORY).alias("likely_scam"),
        F.coalesce("ai_score", F.lit(0)).alias("ai_score"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
        "batch_id",
        "pos",
    )
    return last_write(rows, ["thread_id"], ["batch_id", "pos"]).drop("batch_id", "pos")


def deal_rows(
    threads: DataFrame, thread_users: DataFrame, as_of: Column, value_from_number: bool = False
) -> DataFrame:
    """Rows for the deals table, one per deal thread.

    As stored today, the value is always 0 and the currency USD, because both read
    fields the reply parser does not emit, and the brand is the contact's company.
    `value_from_number=True` stores the parsed value, currency and brand instead.
    """
    users = thread_users.groupBy("thread_id").agg(F.max("user_id").alias("user_id"))
    company = F.coalesce(F.col("main_contact.company"), F.lit(""))
    if value_from_number:
        value = F.coalesce("deal_value", F.lit(0.0))
        currency = F.coalesce("deal_currency", F.lit(fixed.DEFAULT_CURRENCY))
        brand = F.coalesce("deal_brand", company)
    else:
        value, currency, brand = F.lit(0.0), F.lit(fixed.DEFAULT_CURRENCY), company
    rows = (
        threads.filter("is_deal")
        .join(users, "thread_id", "left")
        .select(
            F.col("thread_id").alias("id"),
            F.coalesce("user_id", F.lit("")).alias("user_id"),
            "thread_id",
            F.lit("").alias("email_thread_evaluation_id"),
            straight_quotes(F.col("deal_name")).alias("deal_name"),
            straight_quotes(F.col("deal_type")).alias("deal_type"),
            straight_quotes(F.col("category")).alias("category"),
            value.alias("value"),
            straight_quotes(currency).alias("currency"),
            straight_quotes(brand).alias("brand"),
            F.lit(True).alias("is_ai_sorted"),
            as_of.alias("created_at"),
            as_of.alias("updated_at"),
            "batch_id",
            "pos",
        )
    )
    return last_write(rows, ["thread_id"], ["batch_id", "pos"]).drop("batch_id", "pos")


def no_longer_deals(threads: DataFrame) -> DataFrame:
    """Threads whose stored deal must go; their deal contacts stay."""
    return threads.filter(~F.col("is_deal")).select("thread_id").distinct()


def contact_rows(
    resolved: DataFrame, as_of: Column, lists: RuleLists = DEFAULT_LISTS
) -> tuple[DataFrame, DataFrame]:
    """(contacts, deal contacts) of deal threads with a usable contact.

    `resolved`: thread_id, user_id, creator_email, contact, batch_id, pos. Of several
    contacts with the same user and address the last one counts.
    """
    usable = resolved.filter(is_usable(F.col("contact.email"), F.col("creator_email"), lists)).withColumn(
        "email", straight_quotes(normal_address(F.col("contact.email")))
    )
    user = F.coalesce("user_id", F.lit("")).alias("user_id")
    people = usable.select(
        user,
        "email",
        nullable_text(F.col("contact.name")).alias("name"),
        nullable_text(F.col("contact.company")).alias("company_name"),
        nullable_text(F.col("contact.title")).alias("title"),
        nullable_text(F.col("contact.phone_number")).alias("phone_number"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
        "batch_id",
        "pos",
    )
    links = usable.select(
        F.col("thread_id").alias("deal_id"),
        user,
        "email",
        F.lit(fixed.CONTACT_TYPE).alias("contact_type"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
    ).dropDuplicates(["deal_id", "user_id", "email"])
    return last_write(people, ["user_id", "email"], ["batch_id", "pos"]).drop("batch_id", "pos"), links


def fallback_counts(resolved: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """How many deal threads needed a fallback contact and how many got one."""
    needed = F.col("contact_source") != "reply"
    return resolved.agg(
        F.count_if(needed).alias("candidates"),
        F.count_if(needed & (F.col("contact_source") != "none")).alias("recovered"),
        F.count_if(F.col("contact_source") == "headers").alias("from_headers"),
        F.count_if(F.col("contact_source") == "senders").alias("from_senders"),
    )


def audit_rows(replies: DataFrame, items: DataFrame, email_counts: DataFrame, as_of: Column) -> DataFrame:
    """One audit row per classified batch, with its threads as JSON.

    A batch is one model reply, so its item list is small. `replies`: batch_id,
    model_used; `email_counts`: batch_id, email_count.
    """
    fields = [c for c in items.columns if c not in ("batch_id", "pos")]
    threads = items.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("thread_count"),
        F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("thread")))).alias("_threads"),
    )
    evaluation = F.to_json(
        F.struct(F.transform("_threads", lambda t: t["thread"]).alias("threads")), {"ignoreNullFields": "false"}
    )
    return (
        threads.join(replies.select("batch_id", "model_used"), "batch_id")
        .join(email_counts, "batch_id", "left")
        .select(
            stable_id(F.lit("audit"), F.col("batch_id").cast("string")).alias("id"),
            "batch_id",
            "thread_count",
            F.coalesce("email_count", F.lit(0)).alias("email_count"),
            F.lit(0.0).alias("inference_cost"),
            F.lit(0).cast("bigint").alias("input_tokens"),
            F.lit(0).cast("bigint").alias("output_tokens"),
            "model_used",
            straight_quotes_in_json(evaluation).alias("ai_evaluation"),
            as_of.alias("created_at"),
        )
    )
