"""Byte-level deduplication by suffix sorting (deep-shallow).

A byte goes when a string of `size` bytes that covers it also starts earlier: in a
document before it, or further left in the same one. All occurrences are judged on the
input. Equal strings meet in the bucket of their minimiser (repeats.py). There the
suffixes of the bucket's packed strings are ordered to depth `size`: multikey quicksort
on characters of eight bytes down to a shallow depth, then a blind trie for each group
that still shares that prefix. Suffixes that end in the same leaf are equal strings; all
but the first of them in document order are repeats.

Edge cases: a null or empty text has no bytes and loses none; rows that repeat a doc_id,
or have none, are documents of their own, ordered by (doc_id, text) with nulls first;
an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm import repeats
from threadsift.llm.common import batch, keyed, materialize, small_batches
from threadsift.llm.hashing import blocks

SIZE = 100
CORE = 20
#: Depth in bytes at which multikey quicksort hands over to the blind tries.
SHALLOW = 32


def _characters(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    return out


def shallow_groups(data: np.ndarray, suffixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort to `depth`, a multiple of eight.

    All open groups take one step together: they are ordered by their next eight bytes and
    split where these differ; a group of one is closed. Returns the indexes of the suffixes
    in groups of two or more, in order, and the number of each one's group.
    """
    characters = _characters(data)
    open_, group = np.arange(len(suffixes)), np.zeros(len(suffixes), dtype=np.int64)
    for d in range(0, depth, 8):
        if not len(open_):
            break
        letter = characters[suffixes[open_] + d]
        order = np.lexsort((letter, group))
        open_, group, letter = open_[order], group[order], letter[order]
        split = np.ones(len(open_), dtype=bool)
        split[1:] = (group[1:] != group[:-1]) | (letter[1:] != letter[:-1])
        group = np.cumsum(split) - 1
        several = np.bincount(group)[group] > 1
        open_, group = open_[several], group[several]
    return open_, group


class BlindTrie:
    """A trie of branching positions only; leaves hold the suffixes that are equal to full depth.

    A node is [position, {byte: child}], a leaf the list of members of one string. Insertion
    goes down blindly, compares with any leaf below, and splits where the two first differ.
    """

    def __init__(self):
        self.root: list | None = None
        self.leaves: list[list] = []

    def _leaf(self, text: bytes, member: int) -> list:
        leaf = [text, [member]]
        self.leaves.append(leaf)
        return leaf

    def add(self, text: bytes, member: int) -> None:
        if self.root is None:
            self.root = self._leaf(text, member)
            return
        node = self.root
        while isinstance(node[0], int):
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        seen = node[0]
        if seen == text:
            node[1].append(member)
            return
        at = next(i for i, (a, b) in enumerate(zip(seen, text)) if a != b)
        parent, node = None, self.root
        while isinstance(node[0], int) and node[0] < at:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node[0], int) and node[0] == at:
            node[1][text[at]] = self._leaf(text, member)
            return
        branch = [at, {seen[at]: node, text[at]: self._leaf(text, member)}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch


def equal_suffixes(data: np.ndarray, suffixes: np.ndarray, size: int, shallow: int = SHALLOW) -> list[list[int]]:
    """Classes of two or more suffixes (their indexes) that are equal to depth `size`."""
    shallow = min(shallow, size // 8 * 8)
    open_, group = shallow_groups(data, suffixes, shallow)
    raw = data.tobytes()
    members = open_.tolist()
    begin = (suffixes[open_] + shallow).tolist()
    borders = np.flatnonzero(np.diff(group, prepend=-1, append=-1)).tolist() if len(group) else []
    rest = size - shallow
    out = []
    for a, b in zip(borders, borders[1:]):
        deep = [raw[p : p + rest] for p in begin[a:b]]
        if deep.count(deep[0]) == b - a:
            out.append(members[a:b])
            continue
        trie = BlindTrie()
        for text, member in zip(deep, members[a:b]):
            trie.add(text, member)
        out.extend(leaf[1] for leaf in trie.leaves if len(leaf[1]) > 1)
    return out


def _repeats_in_bucket(size: int):
    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = rows.column("minimiser").to_numpy()
        alone = np.ones(len(keys), dtype=bool)
        same = keys[1:] == keys[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        if alone.all():
            return
        rows = rows.filter(pa.array(~alone))
        strings = rows.column("packed").to_pylist()
        lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        n = rows.column("n").to_numpy()
        base = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        k = rows.column("k").to_numpy()[row]
        start = rows.column("start").to_numpy()[row] + step
        classes = equal_suffixes(data, base[row] + step, size)
        if not classes:
            return
        members = np.fromiter((m for c in classes for m in c), dtype=np.int64)
        number = np.repeat(np.arange(len(classes)), [len(c) for c in classes])
        order = np.lexsort((start[members], k[members], number))
        members, number = members[order], number[order]
        later = members[np.append(False, number[1:] == number[:-1])]
        later = later[np.lexsort((start[later], k[later]))]
        k, start = k[later], start[later]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (start[1:] > start[:-1] + size)
        ends = np.append(np.flatnonzero(new)[1:] - 1, len(k) - 1)
        yield batch(
            {"k": pa.array(k[new]), "first": pa.array(start[new].astype(np.int64)), "stop": pa.array(start[ends].astype(np.int64) + size)}
        )

    return compare


_SPAN = "k long, first long, stop long"


def repeated_spans(docs: DataFrame, size: int = SIZE, core: int = CORE) -> DataFrame:
    """Half-open byte spans (k, first, stop) whose union is what goes; docs as `keyed` gives them."""
    kind = repeats.Symbols("byte", size, core)
    found = repeats.places(docs, kind)
    strings = repeats.distinct_strings(found)
    packed = repeats.packed_strings(docs, strings, kind)
    # 1. A whole super-k-mer that stands earlier elsewhere.
    several = strings.filter("places > 1").select("minimiser", "string", F.col("k").alias("k0"), F.col("start").alias("s0"))
    copies = (
        found.join(several, ["minimiser", "string"])
        .filter("NOT (k = k0 AND start = s0)")
        .selectExpr("k", "CAST(start AS LONG) AS first", f"CAST(start + n - 1 + {size} AS LONG) AS stop")
    )
    # 2. Windows of different super-k-mers of one minimiser, in its bucket.
    sorted_ = repeats.in_buckets(packed, _repeats_in_bucket(size), _SPAN)
    # 3. Windows of minimisers with very many different super-k-mers, one by one.
    single = packed.filter("window IS NOT NULL").select("window", "window2", "k", "start")
    least = materialize(
        single.groupBy("window", "window2")
        .agg(F.min(F.struct("k", "start")).alias("at"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1")
        .select("window", "window2", F.col("at.k").alias("k0"), F.col("at.start").alias("s0"))
    )
    hot = (
        single.join(least, ["window", "window2"])
        .filter("NOT (k = k0 AND start = s0)")
        .selectExpr("k", "CAST(start AS LONG) AS first", f"CAST(start + {size} AS LONG) AS stop")
    )
    with small_batches(docs.sparkSession, 2000, "8m"):
        return materialize(copies.unionByName(sorted_).unionByName(hot))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with their spans as an array of pairs, null where there is none."""
    lists = spans.groupBy("k").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    return docs.join(lists, "k", "left")


def span_arrays(column: pa.ListArray, row: int) -> tuple[np.ndarray, np.ndarray]:
    """One document's spans, merged."""
    if not column[row].is_valid:
        return repeats.merged([])
    lo, hi = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    part = column.values.slice(lo, hi - lo)
    return repeats.merged(np.stack([part.field("first").to_numpy(), part.field("stop").to_numpy()], axis=1))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        spans = rows.column("spans")
        sizes, removed, runs, shas = [], [], [], []
        for block in blocks(rows.column("text")):
            for i in range(len(block)):
                raw = block.raw(i)
                a, b = span_arrays(spans, block.first + i)
                kept, last = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), b.tolist()):
                    kept.update(raw[last:x])
                    last = y
                kept.update(raw[last:])
                sizes.append(len(raw))
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                shas.append(kept.hexdigest())
        yield batch(
            {
                "doc_id": rows.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()),
                "kept_sha256": pa.array(shas, pa.string()),
            }
        )


def digests(documents: DataFrame, size: int = SIZE, core: int = CORE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    docs = keyed(documents)
    kept = with_spans(docs, repeated_spans(docs, size, core)).select(F.col("doc_id").cast("long"), "text", "spans")
    return kept.mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        spans = rows.column("spans")
        texts: list[str | None] = []
        source = rows.column("text")
        for block in blocks(source):
            for i in range(len(block)):
                a, b = span_arrays(spans, block.first + i)
                if not len(a):
                    texts.append(source[block.first + i].as_py())
                    continue
                raw, last, parts = block.raw(i), 0, []
                for x, y in zip(a.tolist(), b.tolist()):
                    parts.append(raw[last:x])
                    last = y
                parts.append(raw[last:])
                # A character that loses some of its bytes goes whole.
                texts.append(b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode())
        yield batch({"k": rows.column("k"), "text": pa.array(texts, pa.string()), "row": rows.column("row")})


def without_repeats(documents: DataFrame, size: int = SIZE, core: int = CORE) -> DataFrame:
    """The documents, all columns, with the repeated bytes cut from their texts.

    A character of which only some bytes go is cut whole. Documents left without any text
    stay, with an empty one.
    """
    docs = keyed(documents)
    joined = with_spans(docs, repeated_spans(docs, size, core)).select("k", "text", "row", "spans")
    cut = joined.mapInArrow(_cut, f"k long, text string, row {joined.schema['row'].dataType.simpleString()}")
    return cut.select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    )
