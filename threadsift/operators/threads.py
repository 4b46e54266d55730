"""Classification text per batch of threads.

A batch text is the concatenation of message segments. Segments are numbered
across the batch and packed into parts of bounded size in bytes, so even a thread with
a large share of all mail never becomes one row. Joining the parts of a batch in order
gives the whole text.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift import fixed_values as fixed
from threadsift.functions.headers import header
from threadsift.functions.scalars import trim_blank
from threadsift.functions.text import clean_body
from threadsift.operators.ranking import in_chunks, numbered

#: Bytes of a part; one longer message makes a part longer by itself.
PART_BYTES = 4 << 20
#: Rows of a slice, and numbers that its parts may take.
_SLICE = 500
_PARTS_OF_SLICE = 1 << 32


def thread_batches(messages: DataFrame, keys: list[str], batch_size: int) -> DataFrame:
    """(keys, thread_id, batch_no, thread_index): the threads of each key in batches of `batch_size`."""
    threads = messages.select(*keys, "thread_id").distinct()
    chunks = in_chunks(threads, keys, "thread_id", batch_size, "batch_no")
    inside = Window.partitionBy(*keys, "batch_no").orderBy(F.md5("thread_id"), "thread_id")
    return chunks.withColumn("thread_index", F.row_number().over(inside))


def message_numbers(messages: DataFrame, per_thread: DataFrame | None = None) -> DataFrame:
    """1-based `message_no` inside each thread, by `position`.

    Positions are cut into slices of fixed width, so long threads are numbered in many tasks.
    """
    return numbered(
        messages,
        ["thread_id"],
        F.floor(F.col("position") / F.lit(1000)),
        [F.col("position"), F.col("message_id")],
        "message_no",
        per_thread,
    )


def cleaned(messages: DataFrame) -> DataFrame:
    """Messages with `clean`, their cleaned and cut body, in place of the raw ones."""
    if "clean" in messages.columns:
        return messages
    raw = F.coalesce(F.nullif("body", F.lit("")), F.nullif("reply_body", F.lit("")), F.lit(""))
    return messages.withColumn("clean", clean_body(raw)).drop("body", "reply_body")


def prepared_messages(messages: DataFrame) -> DataFrame:
    """What a text needs of each message. Bodies are cleaned and cut before any exchange,
    so only short texts travel."""
    headers = F.col("headers")
    return cleaned(messages).select(
        "thread_id",
        "message_id",
        "position",
        "previous_ai_summary",
        header(headers, "from").alias("from_value"),
        header(headers, "date").alias("date_value"),
        header(headers, "subject").alias("subject_value"),
        "clean",
    )


def batch_segments(messages: DataFrame, batches: DataFrame) -> DataFrame:
    """One text segment per message with its place in the batch.

    `messages`: thread_id, message_id, position, headers, previous_ai_summary, and body and
    reply_body or the `clean` text that `cleaned` made of them. `batches`: thread_id, batch_id, thread_index; a batch holds
    few threads, so ordering its threads in a window is bounded.
    """
    counted = messages.groupBy("thread_id").agg(F.count(F.lit(1)).alias("message_count"))
    in_batch = Window.partitionBy("batch_id").orderBy("thread_index")
    before = in_batch.rowsBetween(Window.unboundedPreceding, -1)
    placed = batches.select("thread_id", "batch_id", "thread_index").join(counted, "thread_id").withColumns(
        {
            "offset": F.coalesce(F.sum("message_count").over(before), F.lit(0)),
            "is_last_thread": F.lead("thread_index").over(in_batch).isNull(),
        }
    )
    numbers = message_numbers(prepared_messages(messages), placed)
    message = F.format_string(
        fixed.MESSAGE_FORMAT,
        F.col("message_no"),
        F.col("from_value"),
        F.col("date_value"),
        F.col("subject_value"),
        F.coalesce(F.nullif("clean", F.lit("")), F.lit(fixed.NO_BODY)),
    )
    opening = F.format_string(
        fixed.THREAD_HEADER_FORMAT,
        F.col("thread_index"),
        F.col("message_count"),
        F.coalesce(F.nullif("previous_ai_summary", F.lit("")), F.lit(fixed.NO_SUMMARY)),
    )
    closing = F.when(F.col("is_last_thread"), F.lit(fixed.THREAD_FOOTER)).otherwise(F.lit(fixed.THREAD_FOOTER + "\n"))
    return numbers.select(
        "batch_id",
        "thread_id",
        (F.col("offset") + F.col("message_no")).alias("segment_no"),
        (F.col("message_no") == 1).alias("opens_thread"),
        F.concat(
            F.when(F.col("message_no") == 1, opening).otherwise(F.lit("")),
            message,
            F.when(F.col("message_no") == F.col("message_count"), closing).otherwise(F.lit("")),
        ).alias("segment"),
    )


def in_parts(rows: DataFrame, key: str, number: str, size: Column, most: int) -> DataFrame:
    """`part_no` of each row: the rows of a key in order of `number` (from 1), cut by the sum of their sizes.

    A part holds the rows of one slice (of fixed length, so no key is one task) that begin in
    one half of `most` of the slice's bytes. With rows of up to half of `most` it stays below
    it; only a longer row makes it longer. Parts are numbered upwards with gaps between.
    """
    sliced = rows.withColumns({"_size": size.cast("bigint"), "_slice": F.floor((F.col(number) - 1) / F.lit(_SLICE))})
    inside = Window.partitionBy(key, "_slice").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    begun = sliced.withColumn("_begin", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    part = F.floor(F.col("_begin") / F.lit(max(1, most // 2)))
    return begun.withColumn("part_no", (F.col("_slice") * _PARTS_OF_SLICE + part).cast("bigint")).drop("_size", "_slice", "_begin")


def batch_texts(segments: DataFrame, messages_per_part: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """(batch_id, part_no, thread_data): segments joined in order, part by part.

    Parts are bounded in bytes and numbered upwards with gaps between, or hold a number of
    messages where one is given.
    """
    if messages_per_part is None:
        placed = in_parts(segments, "batch_id", "segment_no", F.octet_length("segment"), part_bytes)
    else:
        placed = segments.withColumn("part_no", F.floor((F.col("segment_no") - 1) / F.lit(messages_per_part)).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct("segment_no", "segment")))
    return (
        placed.groupBy("batch_id", "part_no")
        .agg(ordered.alias("_segments"), F.count_if("opens_thread").alias("threads"), F.count(F.lit(1)).alias("emails"))
        .select(
            "batch_id",
            "part_no",
            F.array_join(F.transform("_segments", lambda s: s["segment"]), "").alias("thread_data"),
            "threads",
            "emails",
        )
    )


def choose_template(model: Column, default: str, llama: str, override: Column | None = None) -> Column:
    """Template by model name; an override text wins."""
    by_model = F.when(F.lower(model).contains(fixed.LLAMA_MODEL_MARK), F.lit(llama)).otherwise(F.lit(default))
    chosen = by_model if override is None else F.coalesce(F.nullif(override, F.lit("")), by_model)
    return trim_blank(chosen)


def user_prompts(texts: DataFrame, template: Column) -> DataFrame:
    """`texts` with `user_prompt`: the template with the thread data put in literally.

    Needs batch_id, part_no, thread_data and creator_email. The text before the mark and
    the creator line go to the first part of a batch, the text after it to the last.
    """
    mark = fixed.THREAD_DATA_MARK
    at = F.instr(template, mark)
    has_creator = F.coalesce(F.col("creator_email"), F.lit("")) != ""
    creator = F.when(has_creator, F.format_string(fixed.CREATOR_LINE_FORMAT, "creator_email")).otherwise("")
    head = F.concat(F.substring(template, F.lit(1), at - 1), creator)
    tail = F.substring(template, at + len(mark), F.length(template))
    first = F.col("part_no") == 0
    last = F.lead("part_no").over(Window.partitionBy("batch_id").orderBy("part_no")).isNull()
    blanks = F.lit(" \t\n\r")
    filled = F.concat(F.when(first, head).otherwise(""), F.col("thread_data"), F.when(F.col("_last"), tail).otherwise(""))
    whole = F.when(at > 0, filled).otherwise(F.when(first, template).otherwise(""))
    cut = F.when(first, F.ltrim(whole, blanks)).otherwise(whole)
    return (
        texts.withColumn("_last", last)
        .withColumn("_cut", cut)
        .withColumn("user_prompt", F.when(F.col("_last"), F.rtrim("_cut", blanks)).otherwise(F.col("_cut")))
        .drop("_last", "_cut")
    )


def size_report(texts: DataFrame) -> DataFrame:
    """Emails, threads and text sizes per batch."""
    return texts.groupBy("batch_id").agg(
        F.sum("emails").alias("emails"),
        F.sum("threads").alias("threads"),
        F.max(F.length("system_prompt")).cast("bigint").alias("system_chars"),
        F.sum(F.length("user_prompt")).alias("user_chars"),
        F.sum(F.length("thread_data")).alias("thread_chars"),
    )


def messages_by_thread(messages: DataFrame, messages_per_part: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Ordered message lists per thread, long threads in several parts.

    A part is bounded by the bytes of its messages' texts, or by their number where one is given.
    """
    numbers = message_numbers(messages)
    if messages_per_part is None:
        texts = [f.name for f in messages.schema.fields if f.dataType.simpleString() == "string" and f.name != "thread_id"]
        lengths = [F.coalesce(F.octet_length(name), F.lit(0)) for name in texts]
        if "headers" in messages.columns:
            lengths.append(F.coalesce(F.octet_length(F.to_json("headers")), F.lit(0)))
        size = reduce(add, lengths, F.lit(0))
        numbers = in_parts(numbers, "thread_id", "message_no", size, part_bytes)
    else:
        numbers = numbers.withColumn("part_no", F.floor((F.col("message_no") - 1) / F.lit(messages_per_part)).cast("bigint"))
    fields = ["message_no", *[c for c in messages.columns if c != "thread_id"]]
    return numbers.groupBy("thread_id", "part_no").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("messages")
    )
