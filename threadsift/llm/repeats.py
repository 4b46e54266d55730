"""Finding repeated windows in a corpus: what word and byte deduplication share.

1. Each text is cut into super-k-mers (see windows.py); minimisers that occur once in
   the corpus are dropped, their windows cannot repeat.
2. Equal super-k-mers are merged before anything else moves: one packed string for each
   (minimiser, hash of the string), with its first place and its number of places.
3. The packed strings travel to the bucket of their minimiser, where the caller's
   function compares their windows. A minimiser with more than HOT different strings
   (a common passage among ever other neighbours) is not sent to one task: its strings
   are cut into single windows, which are grouped by their 128-bit hash: two polynomials
   over different symbol values and bases.

A packed string stands for itself under two 64-bit hashes, that of its minimiser and its
own, so only strings of one minimiser could be taken for each other.

Every step groups or joins on keys; joins are left to adaptive execution, which splits
hot keys, and nothing is kept on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import hashing
from threadsift.llm.common import batch, forget, give_back, ints, longs, materialize, small_batches
from threadsift.llm.windows import super_kmers

#: Different strings of one minimiser beyond which its windows are grouped one by one.
HOT = 2000
#: Bytes of texts that are taken at once; the arrays around them take a hundred times as much.
BLOCK_BYTES = 1 << 18


@dataclass(frozen=True)
class Symbols:
    """What a text is cut into: `unit` is word or byte."""

    unit: str
    size: int
    core: int

    def of(self, block: hashing.Block) -> tuple[np.ndarray, np.ndarray, hashing.Words | None]:
        if self.unit == "byte":
            return hashing.byte_symbols(block), block.bounds, None
        words = hashing.words_of(block, lower=False)
        return words.hashes, words.bounds, words


def _runs(kind: Symbols, keys_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for rows in batches:
            k = rows.column("k").to_numpy(zero_copy_only=False)
            for block in hashing.blocks(rows.column("text"), BLOCK_BYTES):
                symbols, bounds, _ = kind.of(block)
                found = super_kmers(symbols, bounds, kind.size, kind.core)
                if not len(found.key):
                    continue
                if keys_only:
                    yield batch({"minimiser": longs(found.key)})
                    continue
                whole = hashing.Rolling(symbols).ranges(found.at, found.at + found.count + kind.size - 1, 5)
                yield batch(
                    {
                        "minimiser": longs(found.key),
                        "string": longs(whole),
                        "k": pa.array(k[block.first + found.row]),
                        "start": ints(found.start),
                        "n": ints(found.count),
                    }
                )
        give_back()

    return run


def places(docs: DataFrame, kind: Symbols) -> DataFrame:
    """All super-k-mers whose minimiser occurs more than once: minimiser, string (hash), k, start, n."""
    texts = docs.select("k", "text")
    with small_batches(docs.sparkSession, 2000, "8m"):
        once = texts.mapInArrow(_runs(kind, keys_only=True), "minimiser long")
        repeated = materialize(
            once.groupBy("minimiser").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("minimiser")
        )
        all_runs = texts.mapInArrow(_runs(kind, keys_only=False), "minimiser long, string long, k long, start int, n int")
        return materialize(all_runs.join(repeated, "minimiser"))


def distinct_strings(found: DataFrame) -> DataFrame:
    """One row for each different super-k-mer: its first place and the number of its places."""
    return materialize(
        found.groupBy("minimiser", "string")
        .agg(F.min(F.struct("k", "start")).alias("at"), F.count(F.lit(1)).alias("places"), F.first("n").alias("n"))
        .select("minimiser", "string", "at.k", "at.start", "n", "places")
    )


_PACKED = (
    "minimiser long, string long, k long, start int, n int, places long, packed binary, window long, window2 long"
)


def _strings(block: hashing.Block, words: hashing.Words | None, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
    """Ranges of a block's symbols as bytes; words stand one space apart, whatever was between them."""
    raw = block.data.tobytes()
    if words is None:
        return [raw[a:b] for a, b in zip(first.tolist(), stop.tolist())]
    s, e = words.starts.tolist(), words.ends.tolist()
    return [b" ".join([raw[s[i] : e[i]] for i in range(a, b)]) for a, b in zip(first.tolist(), stop.tolist())]


def _pack(kind: Symbols) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts with the super-k-mers to cut from them -> packed strings, or single windows of hot minimisers."""

    def emit(minimiser, string, k, start, n, places, packed, window, window2):
        return batch(
            {
                "minimiser": longs(minimiser),
                "string": longs(string),
                "k": pa.array(k),
                "start": ints(start),
                "n": ints(n),
                "places": pa.array(places),
                "packed": packed,
                "window": window,
                "window2": window2,
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            k = rows.column("k").to_numpy(zero_copy_only=False)
            cuts = rows.column("cuts")
            at = cuts.offsets.to_numpy()
            fields = cuts.values
            f = {name: fields.field(name).to_numpy(zero_copy_only=False) for name in fields.type.names}
            for block in hashing.blocks(rows.column("text"), BLOCK_BYTES):
                symbols, bounds, words = kind.of(block)
                lo, hi = at[block.first], at[block.first + len(block)]
                row = np.repeat(np.arange(len(block)), np.diff(at[block.first : block.first + len(block) + 1]))
                start, n = f["start"][lo:hi], f["n"][lo:hi]
                first = bounds[:-1][row] + start
                hot = f["hot"][lo:hi].astype(bool)
                part = np.flatnonzero(~hot)
                if len(part):
                    a, b = first[part], first[part] + n[part] + kind.size - 1
                    yield emit(
                        f["minimiser"][lo:hi][part],
                        f["string"][lo:hi][part],
                        k[block.first + row[part]],
                        start[part],
                        n[part],
                        f["places"][lo:hi][part],
                        pa.array(_strings(block, words, a, b), pa.binary()),
                        pa.nulls(len(part), pa.int64()),
                        pa.nulls(len(part), pa.int64()),
                    )
                part = np.flatnonzero(hot)
                if len(part):
                    each = np.repeat(part, n[part])
                    step = np.arange(len(each)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
                    a = first[each] + step
                    window = hashing.Rolling(symbols).ranges(a, a + kind.size, 21)
                    window2 = hashing.Rolling.second(symbols).ranges(a, a + kind.size, 22)
                    yield emit(
                        f["minimiser"][lo:hi][each],
                        f["string"][lo:hi][each],
                        k[block.first + row[each]],
                        start[each] + step,
                        np.ones(len(each)),
                        f["places"][lo:hi][each],
                        pa.nulls(len(each), pa.binary()),
                        longs(window),
                        longs(window2),
                    )
        give_back()

    return run


def packed_strings(docs: DataFrame, strings: DataFrame, kind: Symbols) -> DataFrame:
    """The text of every different super-k-mer (packed), or the hashes of the windows of hot minimisers."""
    many = strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > HOT)
    hot = materialize(many.select("minimiser", F.lit(True).alias("hot")))
    marked = strings.join(hot, "minimiser", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    cuts = marked.groupBy("k").agg(
        F.collect_list(F.struct("minimiser", "string", "start", "n", "places", "hot")).alias("cuts")
    )
    joined = docs.select("k", "text").join(cuts, "k")
    with small_batches(docs.sparkSession, 2000, "8m"):
        return materialize(joined.mapInArrow(_pack(kind), _PACKED))


def in_buckets(packed: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """Send packed strings to the bucket of their minimiser; `compare` gets a table of whole minimisers."""
    travelling = packed.filter("packed IS NOT NULL").drop("window", "window2")
    return travelling.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(_by_bucket(compare), schema)


def _by_bucket(compare: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for rows in batches:
            if rows.num_rows == 0:
                continue
            keys = rows.column("minimiser").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last minimiser may go on
            if cut:
                yield from compare(pa.Table.from_batches([*held, rows.slice(0, cut)]))
                held = []
            held.append(rows.slice(cut))
        if held:
            yield from compare(pa.Table.from_batches(held))
        give_back()

    return run


def merged(spans: list[tuple[int, int]] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans as sorted disjoint ones; touching spans become one."""
    spans = np.asarray(spans, dtype=np.int64).reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    if not len(spans):
        return spans[:, 0], spans[:, 1]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    starts = spans[new, 0]
    return starts, reach[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]
