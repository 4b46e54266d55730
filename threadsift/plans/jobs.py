"""Whole jobs composed from the operators, each with its one-row summary.

A job takes tables and a clock and returns the changed tables; the caller writes
them as the next snapshots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.rules import DEFAULT_LISTS, RuleLists
from threadsift.functions.scalars import split_by_valid_id, stable_id
from threadsift.operators import contacts, eligibility, mails, notifications, outcomes, replies, states, threads
from threadsift.operators.mutations import append_missing, apply_changes, delete_matching, upsert_table
from threadsift.operators.ranking import in_chunks
from threadsift.session import materialize, materialize_counting


@dataclass
class JobResult:
    """Changed tables by name, and the job's summary row."""

    tables: dict[str, DataFrame]
    summary: DataFrame


def one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts as a summary row."""
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def sync_job(
    deal_states: DataFrame,
    batch_events: DataFrame,
    metadata: DataFrame,
    as_of: Column,
    max_attempts: int = fixed.MAX_ATTEMPTS,
) -> JobResult:
    """Add states for new mail, then fail batches out of attempts in both active steps."""
    fresh, counts = materialize_counting(states.missing_states(deal_states, metadata, as_of), synced_count=F.count(F.lit(1)))
    # New rows are in neither step, and no row is in both: each looks at the old table.
    steps = {"filtering": "filter", "classifying": "classify"}
    tired = states.active_batches(deal_states, batch_events, list(steps), as_of).filter(F.col("attempts") >= max_attempts)
    dead, failed = materialize_counting(tired, dead_lettered=F.sum("n"))
    swept, events = deal_states, []
    for status, batch_type in steps.items():
        of_step = dead.filter(F.col("status") == status).select("batch_id")
        swept = states.set_status_by_batches(swept, of_step, status, "failed", as_of)
        events.append(states.event_rows(of_step, batch_type, "dead_letter", as_of))
    current = swept.unionByName(fresh)
    summary = one_row(deal_states.sparkSession, {**counts, **failed})
    log = upsert_table("batch_events", batch_events, events[0].unionByName(events[1]), as_of)
    return JobResult({"deal_states": current, "batch_events": log}, summary)


def filter_changes(
    deal_states: DataFrame,
    messages: DataFrame,
    as_of: Column,
    batch_size: int,
    lists: RuleLists = DEFAULT_LISTS,
    retried: DataFrame | None = None,
) -> DataFrame:
    """What becomes of every row to be filtered: its batch and status.

    Pending rows get a new batch (`batch_size` rows of one user); rows of `retried` batches
    that are still 'filtering' keep theirs. A row whose message is not available stays in
    'filtering' and surfaces as stuck later.
    """
    pending = deal_states.filter(F.col("status") == "pending").select("user_id", "email_metadata_id", "message_id")
    chunks = in_chunks(pending, ["user_id"], "email_metadata_id", batch_size)
    stamp = F.date_format(as_of, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    batch_id = stable_id(F.lit("filter"), F.col("user_id"), F.col("chunk_no"), stamp)
    claimed = chunks.select("email_metadata_id", "message_id", batch_id.alias("batch_id"))
    if retried is not None:
        stuck = deal_states.filter((F.col("status") == "filtering") & F.col("batch_id").isNotNull())
        again = stuck.join(retried.select("batch_id"), "batch_id", "left_semi")
        claimed = claimed.unionByName(again.select(*claimed.columns))
    claimed = materialize(claimed)
    judged = mails.verdicts(mails.claimed_messages(messages, claimed), lists)
    return claimed.join(judged, "message_id", "left").select(
        "email_metadata_id", "batch_id", F.coalesce("verdict", F.lit("filtering")).alias("status")
    )


def filter_job(
    deal_states: DataFrame,
    batch_events: DataFrame,
    messages: DataFrame,
    as_of: Column,
    batch_size: int = 200,
    max_attempts: int = fixed.MAX_ATTEMPTS,
    lists: RuleLists = DEFAULT_LISTS,
    retried: DataFrame | None = None,
) -> JobResult:
    """Claim pending rows, apply the rules to every available mail, log the batches and
    fail what ran out of attempts. The claim and the verdict reach the state table in one update.

    `retried`: ids of batches that `retry_job` renewed or split off (`states.renewed_batches`);
    their rows are filtered again under the batch id they have.
    """
    # The summary's counts are taken while the changes and the dead batches are written.
    changes, counts = materialize_counting(
        filter_changes(deal_states, messages, as_of, batch_size, lists, retried),
        total_filtered=F.count_if(F.col("status") == "pending_classification"),
        total_rejected=F.count_if(F.col("status") == "filter_rejected"),
        total_unfetched=F.count_if(F.col("status") == "filtering"),
    )
    filtered = apply_changes(deal_states, changes, as_of)
    # Rows claimed just now are fresh: whatever is out of attempts was so before.
    tired = states.active_batches(deal_states, batch_events, ["filtering"], as_of).filter(F.col("attempts") >= max_attempts)
    dead_ids, failed = materialize_counting(tired.select("batch_id", "n"), stuck_failed=F.sum("n"))
    swept = states.set_status_by_batches(filtered, dead_ids, "filtering", "failed", as_of)
    dead = states.event_rows(dead_ids, "filter", "dead_letter", as_of)
    batches, processed = materialize_counting(changes.select("batch_id").distinct(), batches_processed=F.count(F.lit(1)))
    done = states.event_rows(batches, "filter", "complete", as_of)
    log = upsert_table("batch_events", batch_events, done.unionByName(dead), as_of)
    summary = one_row(deal_states.sparkSession, {**processed, **counts, **failed})
    return JobResult({"deal_states": swept, "batch_events": log}, summary)


@dataclass
class Candidates:
    """What a classification run works on."""

    rows: DataFrame
    skipped: DataFrame
    unavailable: DataFrame
    batches: DataFrame
    texts: DataFrame


def select_candidates(
    deal_states: DataFrame,
    evaluations: DataFrame,
    user_settings: DataFrame,
    deals: DataFrame,
    messages: DataFrame,
    batch_size: int = 5,
    retried: DataFrame | None = None,
) -> Candidates:
    """Complete threads with readable mail that no stored deal covers yet, as batch texts.

    Batches hold threads of one user, so the creator line belongs to every thread in it.
    `retried`: ids of batches whose rows are still 'classifying' and take part again, under
    the batch id they have.
    """
    ready = deal_states.filter(F.col("status") == "pending_classification")
    ready = ready.join(states.complete_threads(deal_states), "thread_id", "left_semi").select(*states.BATCH_COLUMNS)
    again = None
    if retried is not None:
        stuck = deal_states.filter((F.col("status") == "classifying") & F.col("batch_id").isNotNull())
        stuck = stuck.join(retried.select("batch_id"), "batch_id", "left_semi")
        again = stuck.select("batch_id", "thread_id").distinct()
        ready = ready.unionByName(stuck.select(*states.BATCH_COLUMNS))
    # Every table a classification run changes follows from these rows and batches.
    rows = materialize(
        states.with_previous_evaluation(ready, evaluations, user_settings)
    )
    owners = rows.groupBy("thread_id").agg(
        F.max("user_id").alias("user_id"), F.max("creator_email").alias("creator_email")
    )
    # Raw bodies end here: every later join carries a cleaned text of bounded length.
    claimed = threads.cleaned(mails.claimed_messages(messages.drop("user_id"), rows))
    placed = mails.own_threads(mails.enrich(claimed, rows)).join(owners, "thread_id")
    skipped = outcomes.already_evaluated(mails.latest_mail_dates(placed), deals)
    unavailable = outcomes.unavailable_threads(rows, messages)
    open_mails = placed.join(skipped, "thread_id", "left_anti")
    fresh_mails = open_mails if again is None else open_mails.join(again, "thread_id", "left_anti")
    placed_threads = threads.thread_batches(fresh_mails, ["user_id"], batch_size)
    # A later run numbers a user's batches anew: what is in a batch makes its id unique.
    contents = placed_threads.groupBy("user_id", "batch_no").agg(
        F.md5(F.array_join(F.array_sort(F.collect_list("thread_id")), "|")).alias("contents")
    )
    batches = placed_threads.join(contents, ["user_id", "batch_no"]).select(
        "thread_id",
        "thread_index",
        F.concat_ws(":", F.lit("classify"), "user_id", "batch_no", "contents").alias("batch_id"),
    )
    if again is not None:
        # A batch holds few threads, so its window is small.
        order = Window.partitionBy("batch_id").orderBy(F.md5("thread_id"), "thread_id")
        renumbered = again.join(open_mails.select("thread_id").distinct(), "thread_id", "left_semi").select(
            "thread_id", F.row_number().over(order).alias("thread_index"), "batch_id"
        )
        batches = batches.unionByName(renumbered)
    batches = materialize(batches)
    texts = threads.batch_texts(threads.batch_segments(open_mails, batches))
    creators = (
        batches.join(owners, "thread_id")
        .groupBy("batch_id")
        .agg(F.max("creator_email").alias("creator_email"))
    )
    return Candidates(rows, skipped, unavailable, batches, texts.join(creators, "batch_id", "left"))


def classify_job(
    tables: dict[str, DataFrame],
    candidates: Candidates,
    raw_replies: DataFrame,
    messages: DataFrame,
    as_of: Column,
    value_from_number: bool = False,
    lists: RuleLists = DEFAULT_LISTS,
) -> JobResult:
    """Apply model replies to the evaluation, deal, contact, audit, event and state tables.

    `raw_replies`: batch_id, layer, model, raw. A stored audit of a batch comes before any of
    them. Rows of batches without a usable reply stay 'classifying' under the batch id and
    its 'new' event, so attempts count; batches out of attempts and stale rows that no batch
    ever took fail. The parsed items feed six tables, so they are written once.
    """
    ids = candidates.batches.select("batch_id").distinct()
    stored = tables["ai_evaluation_audits"].select("batch_id", "ai_evaluation").join(ids, "batch_id", "left_semi")
    cached = replies.cached_threads(stored).select(
        "batch_id", F.lit("cached").alias("layer"), F.lit(None).cast("string").alias("model"), "items"
    )
    given = replies.parse_replies(raw_replies).select("batch_id", "layer", "model", "items")
    best = materialize(replies.first_usable_reply(given.unionByName(cached)))
    items = replies.reply_items(best.select("batch_id", "items"), candidates.batches)
    items, rejected = split_by_valid_id(materialize(items), "thread_id")
    rows = candidates.rows
    evaluations = upsert_table(
        "evaluations", tables["email_thread_evaluations"], outcomes.evaluation_rows(items, as_of), as_of
    )
    deal_rows = outcomes.deal_rows(items, rows.select("thread_id", "user_id"), as_of, value_from_number)
    kept = delete_matching(tables["deals"], outcomes.no_longer_deals(items), "thread_id")
    deals = upsert_table("deals", kept, deal_rows, as_of)

    people = rows.groupBy("thread_id").agg(
        F.max("user_id").alias("user_id"), F.max("creator_email").alias("creator_email")
    )
    found = items.filter("is_deal").select("batch_id", "pos", "thread_id", "main_contact").join(people, "thread_id", "left")
    # Only deal threads need a contact from elsewhere.
    sought = found.select("thread_id").distinct()
    placed = mails.enrich(mails.claimed_messages(messages, rows), rows).join(sought, "thread_id", "left_semi")
    from_headers = contacts.latest_header_sender(placed, people, lists)
    from_store = contacts.latest_stored_sender(
        tables["email_metadata"].join(sought, "thread_id", "left_semi"),
        tables["email_senders"],
        tables["user_sync_settings"],
        lists,
    )
    resolved = contacts.resolve_contacts(found, from_headers, from_store, lists)
    contact_rows, link_rows = outcomes.contact_rows(resolved, as_of, lists)

    verdicts = items.select("thread_id", "is_deal")
    answered = best.filter(F.col("layer").isNotNull()).select("batch_id")
    failed = candidates.batches.join(answered, "batch_id", "left_anti").select("thread_id", "batch_id")
    settled = rows.join(failed, "thread_id", "left_anti")
    changes = outcomes.terminal_changes(settled, verdicts, candidates.skipped, tables["email_thread_evaluations"])
    placed_rows = rows.select("email_metadata_id", "thread_id").join(candidates.batches, "thread_id")
    changes = changes.join(placed_rows.select("email_metadata_id", "batch_id"), "email_metadata_id", "left")
    waiting = rows.join(failed, "thread_id").select(
        "email_metadata_id", F.lit("classifying").alias("status"), "batch_id"
    )
    changes = materialize(changes.unionByName(waiting))
    classified = apply_changes(tables["deal_states"], changes, as_of, keep_batch=True)
    # What this run claims is fresh, so the batches out of attempts are those of the old table.
    dead = states.dead_batches(tables["deal_states"], tables["batch_events"], "classifying", as_of).select("batch_id")
    dead = materialize(dead.join(ids, "batch_id", "left_anti"))
    swept = states.set_status_by_batches(classified, dead, "classifying", "failed", as_of)
    orphaned = (["pending_classification"], fixed.ORPHAN_MINUTES, as_of)
    orphan_count = states.count_orphans(classified, *orphaned)
    new_states = states.fail_orphans(swept, *orphaned)

    email_counts = rows.join(candidates.batches, "thread_id").groupBy("batch_id").agg(F.count(F.lit(1)).alias("email_count"))
    new_audits = outcomes.audit_rows(best.filter(F.col("layer") != "cached"), items, email_counts, as_of)
    done = (
        states.event_rows(answered, "classify", "complete", as_of)
        .unionByName(states.event_rows(failed.select("batch_id").distinct(), "classify", "new", as_of))
        .unionByName(states.event_rows(dead, "classify", "dead_letter", as_of))
    )
    summary = changes.agg(
        F.count_if(F.col("status") == "deal").alias("deal_rows"),
        F.count_if(F.col("status") == "not_deal").alias("not_deal_rows"),
    ).withColumns(
        {
            "batches_processed": answered.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "batches_failed": failed.agg(F.count_distinct("batch_id").alias("n")).scalar(),
            "rejected_items": rejected.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "stuck_failed": states.count_in_batches(tables["deal_states"], dead, "classifying").scalar(),
            "orphan_failed": orphan_count.scalar(),
        }
    )
    return JobResult(
        {
            "email_thread_evaluations": evaluations,
            "deals": deals,
            "contacts": upsert_table("contacts", tables["contacts"], contact_rows, as_of),
            "deal_contacts": upsert_table("deal_contacts", tables["deal_contacts"], link_rows, as_of),
            "ai_evaluation_audits": append_missing(tables["ai_evaluation_audits"], new_audits, "batch_id"),
            "batch_events": upsert_table("batch_events", tables["batch_events"], done, as_of),
            "deal_states": new_states,
        },
        summary,
    )


def retry_job(
    deal_states: DataFrame,
    batch_events: DataFrame,
    as_of: Column,
    filter_size: int = 200,
    classify_size: int = 5,
    max_attempts: int = fixed.MAX_ATTEMPTS,
) -> JobResult:
    """Renew the stuck batches of both active steps; stuck parent batches are split.

    Its events name the batches (`states.renewed_batches`) that `filter_job` and
    `select_candidates` can take again.
    """
    current, events = deal_states, []
    for status, batch_type, size in (("filtering", "filter", filter_size), ("classifying", "classify", classify_size)):
        current, new = states.retry_stuck(current, batch_events, status, batch_type, as_of, size, max_attempts=max_attempts)
        events.append(new)
    added, counts = materialize_counting(
        events[0].unionByName(events[1]),
        batches_renewed=F.count_if(F.col("event_type") == "retrigger"),
        batches_split_off=F.count_if(F.col("event_type") == "new"),
    )
    summary = one_row(deal_states.sparkSession, counts)
    log = upsert_table("batch_events", batch_events, added, as_of)
    return JobResult({"deal_states": current, "batch_events": log}, summary)


def recovery_job(
    deal_states: DataFrame,
    messages: DataFrame,
    as_of: Column,
    user_limit: int | None = None,
    rows_per_user: int | None = None,
) -> JobResult:
    """Return failed rows to the queue where their message can still be read."""
    found = states.split_by_availability(states.failed_rows(deal_states, user_limit, rows_per_user), messages)
    rows, counts = materialize_counting(
        found.select("email_metadata_id", "user_id", "is_available"),
        total_recovered=F.count_if("is_available"),
        total_dead=F.count_if(~F.col("is_available")),
    )
    # Distinct users cannot be counted on the way; the rows just written are few and have one narrow column for it.
    counts["users_processed"] = rows.agg(F.count_distinct("user_id")).first()[0]
    return JobResult({"deal_states": states.apply_recovery(deal_states, rows, as_of)}, one_row(deal_states.sparkSession, counts))


def notify_job(tables: dict[str, DataFrame], markers: DataFrame, limit: int | None = None) -> JobResult:
    """Outbox rows for users whose first scan is complete and who were not told yet."""
    report = eligibility.eligible_report(
        tables["sync_states"],
        tables["sync_events"],
        tables["email_metadata"],
        tables["deal_states"],
        tables["deals"],
        tables["deal_contacts"],
        tables["contacts"],
        limit,
    )
    return JobResult({"outbox": notifications.outbox(report, markers)}, notifications.summary(report, markers))

