"""Who the external contact of a deal thread is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.functions.headers import address, display_name, header, mail_date
from threadsift.functions.rules import DEFAULT_LISTS, RuleLists, blocked_address
from threadsift.functions.scalars import blank_to_null, bound, trim_blank
from threadsift.operators.ranking import latest_per_key


def normal_address(email: Column) -> Column:
    return F.lower(trim_blank(F.coalesce(email, F.lit(""))))


def is_usable(email: Column, creator_email: Column, lists: RuleLists = DEFAULT_LISTS) -> Column:
    """Non-empty, not the creator, not a blocked sender."""
    creator = normal_address(creator_email)
    return bound(
        normal_address(email),
        lambda mail: (mail != "") & ((creator == "") | (mail != creator)) & ~blocked_address(mail, lists),
    )


def latest_stored_sender(
    metadata: DataFrame, senders: DataFrame, user_settings: DataFrame, lists: RuleLists = DEFAULT_LISTS
) -> DataFrame:
    """Newest usable sender per thread and user from the senders table.

    Unusable senders are filtered out before anything is compared, and the newest is
    kept by a map-side aggregation: no thread is ever sorted as a whole, and none is
    cut off after a number of rows.
    """
    creators = user_settings.select("user_id", F.col("email").alias("creator_email"))
    rows = (
        metadata.select(F.col("id").alias("email_metadata_id"), "user_id", "thread_id", "received_at")
        .join(senders, "email_metadata_id")
        .join(creators, "user_id", "left")
        .filter(is_usable(F.col("sender_email"), F.col("creator_email"), lists))
    )
    candidates = rows.select(
        "thread_id",
        "user_id",
        "received_at",
        "email_metadata_id",
        normal_address(F.col("sender_email")).alias("email"),
        blank_to_null(trim_blank(F.col("sender_name"))).alias("name"),
    )
    latest = latest_per_key(
        candidates, ["thread_id", "user_id"], [F.col("received_at"), F.col("email_metadata_id")]
    )
    return latest.select("thread_id", "user_id", "email", "name")


def latest_header_sender(mails: DataFrame, creators: DataFrame, lists: RuleLists = DEFAULT_LISTS) -> DataFrame:
    """Newest usable sender per thread from the mails' own headers.

    An unreadable date counts as the epoch; among equal dates the lowest `position` wins.
    `creators`: thread_id, creator_email.
    """
    epoch = F.lit(0).cast("timestamp")
    sender = header(F.col("headers"), "from")
    candidates = (
        mails.select(
            "thread_id",
            "position",
            F.coalesce(mail_date(header(F.col("headers"), "date")), epoch).alias("sent"),
            address(sender).alias("email"),
            blank_to_null(display_name(sender)).alias("name"),
        )
        .join(creators.select("thread_id", "creator_email"), "thread_id", "left")
        .filter(is_usable(F.col("email"), F.col("creator_email"), lists))
    )
    newest = candidates.groupBy("thread_id").agg(
        F.max_by(F.struct("email", "name"), F.struct(F.col("sent"), (-F.col("position")).alias("p"))).alias("c")
    )
    return newest.select("thread_id", "c.email", "c.name")


def resolve_contacts(
    deals: DataFrame,
    header_senders: DataFrame,
    stored_senders: DataFrame,
    lists: RuleLists = DEFAULT_LISTS,
) -> DataFrame:
    """Deal threads with their final `contact` and its `contact_source`.

    The reply's own contact is kept when usable; else the header sender, else the
    stored sender. `deals`: thread_id, user_id, creator_email, main_contact.
    """

    def as_contact(email: str, name: str) -> Column:
        empty = F.lit(None).cast("string")
        return F.struct(
            F.col(name).alias("name"),
            F.col(email).alias("email"),
            empty.alias("company"),
            empty.alias("title"),
            empty.alias("phone_number"),
        )

    from_headers = header_senders.select("thread_id", F.col("email").alias("h_email"), F.col("name").alias("h_name"))
    from_store = stored_senders.select(
        "thread_id", "user_id", F.col("email").alias("s_email"), F.col("name").alias("s_name")
    )
    joined = deals.join(from_headers, "thread_id", "left").join(from_store, ["thread_id", "user_id"], "left")
    own = F.coalesce(is_usable(F.col("main_contact.email"), F.col("creator_email"), lists), F.lit(False))
    by_header, by_store = F.col("h_email").isNotNull(), F.col("s_email").isNotNull()
    return joined.withColumns(
        {
            "contact": F.when(own, F.col("main_contact"))
            .when(by_header, as_contact("h_email", "h_name"))
            .when(by_store, as_contact("s_email", "s_name")),
            "contact_source": F.when(own, "reply")
            .when(by_header, "headers")
            .when(by_store, "senders")
            .otherwise("none"),
        }
    ).drop("h_email", "h_name", "s_email", "s_name")
