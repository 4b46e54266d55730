"""Word-level deduplication of repeated passages by super-k-mer partitioning.

A window is `size` consecutive words of one document. Every word covered by a window
whose words also stand anywhere else goes, at all its places; windows are judged on the
input. Consecutive windows that share a minimiser travel as one packed string to its
bucket, where sorting brings equal windows together and counts them exactly.

Words are the runs of bytes other than space and U+0009 to U+000D, compared unchanged.
Edge cases: a null, empty or blank text has no words; rows that repeat a doc_id, or have
none, are documents of their own; an empty table gives an empty result. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import repeats
from threadsift.llm.common import batch, keyed, materialize
from threadsift.llm.hashing import blocks, words_of
from threadsift.llm.suffix_dedup import span_arrays, with_spans

SIZE = 35
CORE = 8

_FLAGS = "minimiser long, string long, offset int, length int"


def _count_in_bucket(size: int):
    """Counts the windows of the bucket's packed strings by sorting them."""

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        minimiser = rows.column("minimiser").to_numpy()
        string = rows.column("string").to_numpy()
        places = rows.column("places").to_numpy()
        n = rows.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        windows: list[bytes] = []
        for packed in rows.column("packed").to_pylist():
            cuts = [-1, *np.flatnonzero(np.frombuffer(packed, dtype=np.uint8) == 32).tolist(), len(packed)]
            windows.extend(packed[a + 1 : b] for a, b in zip(cuts, cuts[size:]))
        order = sorted(range(len(windows)), key=windows.__getitem__)
        new = np.ones(len(order), dtype=bool)
        new[1:] = [windows[a] != windows[b] for a, b in zip(order, order[1:])]
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        repeated = np.bincount(number, weights=places[row])[number] > 1
        # Runs of repeated windows of one packed string.
        first = repeated.copy()
        first[1:] &= ~repeated[:-1] | (row[1:] != row[:-1])
        last = repeated.copy()
        last[:-1] &= ~repeated[1:] | (row[1:] != row[:-1])
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        if len(a):
            yield batch(
                {
                    "minimiser": pa.array(minimiser[row[a]]),
                    "string": pa.array(string[row[a]]),
                    "offset": pa.array(step[a].astype(np.int32)),
                    "length": pa.array((b - a + size).astype(np.int32)),
                }
            )

    return compare


def repeated_spans(docs: DataFrame, size: int = SIZE, core: int = CORE) -> DataFrame:
    """Half-open word spans (k, first, stop) whose union is what goes; docs as `keyed` gives them."""
    kind = repeats.Symbols("word", size, core)
    found = repeats.places(docs, kind)
    strings = repeats.distinct_strings(found)
    packed = repeats.packed_strings(docs, strings, kind)
    counted = repeats.in_buckets(packed, _count_in_bucket(size), _FLAGS)
    # Minimisers with very many different super-k-mers: windows one by one.
    single = packed.filter("window IS NOT NULL").join(
        strings.select("minimiser", "string", F.col("start").alias("s0")), ["minimiser", "string"]
    )
    single = single.selectExpr("window", "window2", "minimiser", "string", "start - s0 AS offset", "places")
    total = materialize(
        single.groupBy("window", "window2").agg(F.sum("places").alias("c")).filter("c > 1").select("window", "window2")
    )
    hot = single.join(total, ["window", "window2"]).selectExpr(
        "minimiser", "string", "offset", f"CAST({size} AS INT) AS length"
    )
    flags = materialize(counted.unionByName(hot))
    spans = found.join(flags, ["minimiser", "string"]).selectExpr(
        "k", "CAST(start + offset AS LONG) AS first", "CAST(start + offset + length AS LONG) AS stop"
    )
    return materialize(spans)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        spans = rows.column("spans")
        counts, removed, shas = [], [], []
        for block in blocks(rows.column("text")):
            words = words_of(block, lower=False)
            raw = block.data.tobytes()
            for i in range(len(block)):
                lo, hi = int(words.bounds[i]), int(words.bounds[i + 1])
                a, b = span_arrays(spans, block.first + i)
                stay = np.ones(hi - lo, dtype=bool)
                for x, y in zip(a.tolist(), b.tolist()):
                    stay[x:y] = False
                which = lo + np.flatnonzero(stay)
                kept = b" ".join(
                    [raw[x:y] for x, y in zip(words.starts[which].tolist(), words.ends[which].tolist())]
                )
                counts.append(hi - lo)
                removed.append(hi - lo - len(which))
                shas.append(hashlib.sha256(kept).hexdigest())
        yield batch(
            {
                "doc_id": rows.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(shas, pa.string()),
            }
        )


def digests(documents: DataFrame, size: int = SIZE, core: int = CORE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every document."""
    docs = keyed(documents)
    kept = with_spans(docs, repeated_spans(docs, size, core)).select(F.col("doc_id").cast("long"), "text", "spans")
    return kept.mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")
