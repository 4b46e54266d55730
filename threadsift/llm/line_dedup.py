"""Line dedup: lines that stand in several documents go from all but the first of them.

DataFrame functions only. Every text is split at line feeds; a line's key is the line
without white space (space, U+0009 to U+000D) at both ends and with A-Z lowered, and
stands for itself in the shuffles as the first 128 bits of its SHA-256. The distinct
keys of a document are exploded and counted by hash, which counts documents and not
lines, with partial counts on the map side. Hashes of `min_docs` documents or more are
written with the least of these documents. Then each line of such a hash in another
document is marked by its position, and a document is put together again from the runs
of lines between its marked positions. Texts travel once, to meet their positions.

A line that stands in a large part of all documents is one row after partial counting.
For marking, hashes of more than 1/65,536 of what was counted (so at most 65,536 rows,
however large the corpus) are broadcast; lines of the others are joined by hash, and
lines already answered are spread over all tasks instead of meeting under their hash.

Edge cases: a null or empty text is one empty line and stays as the empty text. Keys of
fewer than `min_chars` code points never go. Lines repeated inside one document only
stay. Carriage returns before a line feed stay in the line but not in its key. Rows that
repeat a doc_id, or have none, count as documents of their own (nulls first, then by
text). An empty table gives an empty result. Other columns are not looked at; `cleaned`
carries them along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import keyed, materialize

MIN_CHARS = 10
MIN_DOCS = 2
#: A hash of more than this part of all counted rows is hot, so there are no more hot ones than this.
HOT = 1 << 16

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line without white space at both ends, A-Z lowered."""
    bare = F.btrim(line, F.lit(_SPACE))
    # Where all is ASCII, lower() does nothing but what translate() does, and is faster.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hash_of(line: Column, min_chars: int) -> Column:
    """128 bits of a line's key as text; null for a line whose key is too short to count."""
    # Bound by transform: the key is used twice but computed once.
    known = F.transform(F.array(key_of(line)), lambda key: F.when(F.char_length(key) >= min_chars, F.substring(F.sha2(key, 256), 1, 32)))
    return known[0]


def repeated(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """hash, first_k, n_docs of the line keys that stand in `min_docs` documents or more.

    `documents` has k, unique, and text.
    """
    hashes = F.transform(lines_of(F.col("text")), lambda line: _hash_of(line, min_chars))
    held = documents.select("k", F.explode(F.array_distinct(F.array_compact(hashes))).alias("hash"))
    counted = held.select("k", F.unhex("hash").alias("hash")).groupBy("hash").agg(F.min("k").alias("first_k"), F.count(F.lit(1)).alias("n_docs"))
    return counted.filter(F.col("n_docs") >= min_docs)


def dropped_lines(documents: DataFrame, rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """k and the increasing positions (from 0) of its lines that go; documents that keep all lines are left out.

    `rows` is a written result of `repeated`.
    """
    total = rows.agg(F.sum("n_docs")).first()[0] or 0
    is_hot = F.col("n_docs") * F.lit(HOT) > F.lit(total)
    hot = rows.filter(is_hot).select("hash", F.col("first_k").alias("hot_first"))
    cold = rows.filter(~is_hot).select(F.col("hash").alias("cold_hash"), F.col("first_k").alias("cold_first"))
    hashes = F.transform(lines_of(F.col("text")), lambda line: _hash_of(line, min_chars))
    lines = documents.select("k", F.posexplode(hashes).alias("position", "hash")).filter(F.col("hash").isNotNull())
    marked = lines.select("k", "position", F.unhex("hash").alias("hash")).join(F.broadcast(hot), "hash", "left")
    # An answered line needs no partner: a key of its own spreads such lines evenly.
    own = F.unhex(F.hex(F.xxhash64("k", "position")))
    asked = marked.select("k", "position", "hot_first", F.when(F.col("hot_first").isNull(), F.col("hash")).otherwise(own).alias("ask"))
    answered = asked.join(cold, F.col("ask") == F.col("cold_hash"), "left")
    goes = F.col("k") != F.coalesce("hot_first", "cold_first")
    return answered.filter(goes).groupBy("k").agg(F.array_sort(F.collect_list("position")).alias("positions"))


def _without(lines: Column, positions: Column) -> Column:
    """The lines at other positions: the runs between the given ones, one slice each."""
    edges = F.concat(F.array(F.lit(-1)), positions, F.array(F.size(lines)))
    # element_at counts from 1: run i lies between edges i and i + 1.
    runs = F.transform(
        F.sequence(F.lit(1), F.size(edges) - 1),
        lambda i: F.slice(lines, F.element_at(edges, i) + 2, F.element_at(edges, i + 1) - F.element_at(edges, i) - 1),
    )
    return F.flatten(runs)


def deduplicated(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """k, doc_id, row, n_lines, n_dropped, kept (the text of the lines that stay) for every document."""
    docs = keyed(documents)
    small = docs.select("k", "text")
    gone = dropped_lines(small, materialize(repeated(small, min_docs, min_chars)), min_chars).withColumnRenamed("k", "gone_k")
    joined = docs.join(gone, docs["k"] == gone["gone_k"], "left")
    lines, positions = lines_of(F.col("text")), F.col("positions")
    return joined.select(
        "k",
        "doc_id",
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.when(positions.isNull(), 0).otherwise(F.size(positions)).cast("long").alias("n_dropped"),
        F.when(positions.isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(_without(lines, positions), "\n")).alias("kept"),
    )


def cleaned(documents: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with only the lines that stay, other columns as they were."""
    rows = deduplicated(documents, min_docs, min_chars)
    return rows.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every document."""
    rows = deduplicated(documents)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position FROM documents),
keys AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines),
found AS (SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.doc_id, k.line, k.position, coalesce(k.doc_id <> f.first, FALSE) AS gone FROM keys k LEFT JOIN found f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
