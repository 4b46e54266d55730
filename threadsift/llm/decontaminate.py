"""Benchmark decontamination: which documents hold which test items.

Size-partitioned MinHash containment search, in DataFrame operations only. An item is
contained in a document when `percent` of its distinct five-word shingles stand in it.
Such an item shares with the document at least one of the floor((100 - percent) / 100 * n) + 1
least hashes of its n shingles: the others are too few to make up the rest. So:

1. Items are partitioned by the size of their sets, in powers of two. The signature of an
   item is its MinHash: as many least hashes as the upper size of its partition asks for.
2. A document takes part in a partition only if it has shingles enough to contain its
   smallest item, and only with the shingles whose hash is not above the partition's
   largest signature value; for long documents that is a fraction of them.
3. Documents and items that share a signature value are candidates. For candidates alone
   the containment is counted exactly, on the words of the shingles themselves.

Words are runs of characters other than space and U+0009 to U+000D, in lower case. A text
of fewer words than five, but one at least, has one shingle: all of them.

Edge cases: null or blank items and documents have no shingles and are never reported.
Rows that repeat a doc_id, or have none, are documents of their own and reported each;
so are repeated items. Empty tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import keyed, materialize

SHINGLE = 5
PERCENT = 80
#: Signature rows up to which the signatures are sent to every task; beyond it both sides are shuffled.
SIGNATURE_ROWS = 200_000


def _words(text: Column) -> Column:
    # Without the empty strings that leading or trailing white space leaves.
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+"), "")


def _bound(value: Column, use) -> Column:
    """`use` of a value that is computed once: a lambda variable stands for it."""
    return F.transform(F.array(value), use)[0]


def _runs(words: Column, make) -> Column:
    """`make` applied to each run of SHINGLE words (a slice of the array); no words, no runs."""

    def of(w: Column) -> Column:
        last = F.greatest(F.size(w) - (SHINGLE - 1), F.least(F.size(w), F.lit(1)))
        starts = F.filter(F.sequence(F.lit(0), last), lambda i: i > 0)
        return F.transform(starts, lambda i: make(F.slice(w, i, SHINGLE)))

    return _bound(words, of)


def shingle_texts(text: Column) -> Column:
    """Distinct shingles of a text, as text."""
    return F.array_distinct(_runs(_words(text), lambda run: F.concat_ws(" ", run)))


def shingle_hashes(text: Column) -> Column:
    """Hashes of all shingles of a text, repeated ones repeated. Words are hashed once, runs of hashes again."""
    return _runs(F.transform(_words(text), lambda w: F.xxhash64(w)), lambda run: F.xxhash64(run))


def _size_class(n: Column) -> Column:
    """The power of two that a set's size does not exceed."""
    return F.pow(F.lit(2), F.ceil(F.log2(n.cast("double")))).cast("long")


def signatures(items: DataFrame, percent: int) -> DataFrame:
    """item, size_class, value: the least hashes of each item, as many as its partition needs. items: item, text."""
    hashed = items.select("item", F.array_sort(F.array_distinct(shingle_hashes(F.col("text")))).alias("h"))
    sized = hashed.filter(F.size("h") > 0).withColumn("size_class", _size_class(F.size("h")))
    needed = F.floor(F.col("size_class") * (100 - percent) / 100).cast("int") + 1
    return sized.select("item", "size_class", F.size("h").alias("n"), F.explode(F.slice("h", 1, needed)).alias("value"))


def contained(documents: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """k, item, n_shared, n_shingles for every item contained in a document.

    documents: k, text as `keyed` gives them; items: item, text with unique, non-null items.
    """
    signed = materialize(signatures(items, percent))
    # One row for each partition: what a document must have to take part, and how high its hashes may be.
    partitions = signed.groupBy("size_class").agg(F.max("value").alias("highest"), F.min("n").alias("smallest"))
    bounds = partitions.agg(F.max("highest").alias("highest"), F.min("smallest").alias("smallest")).first()
    if bounds["highest"] is None:
        return documents.select("k", F.lit(None).cast("long").alias("item"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_shingles")).filter("false")
    signed = signed.join(F.broadcast(partitions.select("size_class", "smallest")), "size_class")  # a row per power of two
    hashed = documents.select("k", shingle_hashes(F.col("text")).alias("h")).filter(F.size("h") * 100 >= bounds["smallest"] * percent)
    low = hashed.select("k", F.size("h").alias("size"), F.explode(F.filter("h", lambda x: x <= F.lit(bounds["highest"]))).alias("value"))
    if signed.count() <= SIGNATURE_ROWS:
        signed = F.broadcast(signed)
    hits = low.join(signed, "value").filter(F.col("size") * 100 >= F.col("smallest") * percent)
    candidates = materialize(hits.select("k", "item").distinct())
    # Exact containment: candidates are few, and only they are read again.
    per_item = items.select("item", shingle_texts(F.col("text")).alias("parts"))
    chosen = candidates.join(per_item, "item").select("k", "item", "parts")
    texts = documents.select("k", "text").join(candidates.select("k").distinct(), "k", "left_semi")
    texts = texts.select("k", shingle_texts(F.col("text")).alias("own"))
    checked = chosen.join(texts, "k").select(
        "k", "item", F.size(F.array_intersect("parts", "own")).alias("n_shared"), F.size("parts").alias("n_shingles")
    )
    return checked.filter(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)


def _items(benchmark: DataFrame) -> DataFrame:
    keys = keyed(benchmark.select(F.col("item_id").alias("doc_id"), "text"))
    return keys.select(F.col("k").alias("item"), F.col("doc_id").alias("item_id"), "text")


def contaminated(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment: every test item found in a document."""
    docs, items = keyed(documents), _items(benchmark)
    found = contained(docs, items.select("item", "text"), percent)
    return (
        found.join(docs.select("k", F.col("doc_id").cast("long")), "k")
        .join(items.select("item", F.col("item_id").cast("long")), "item")
        .select("doc_id", "item_id", "n_shared", "n_shingles", F.try_divide("n_shared", "n_shingles").alias("containment"))
    )


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, that contain no test item."""
    docs = keyed(documents)
    found = materialize(contained(docs, _items(benchmark).select("item", "text"), percent).select("k").distinct())
    return docs.join(found, "k", "left_anti").select("row.*")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') AS w
 FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') AS w
 FROM benchmark),
ds AS (SELECT DISTINCT k, doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
bs AS (SELECT DISTINCT item, item_id, array_to_string(w[i:i + 4], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT item, CAST(count(*) AS INTEGER) AS n_shingles FROM bs GROUP BY item)
SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item) GROUP BY k, doc_id, item, item_id, n_shingles
HAVING count(*) * 100 >= n_shingles * 80
"""
