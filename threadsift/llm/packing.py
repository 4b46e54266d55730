"""Packing documents into token sequences: order-preserving dynamic programming.

Documents are taken in the order of their ids and cut into ranges that each go to one
task. The tokens of a range are one stream, and its sequences are consecutive windows of
it. The windows' borders are chosen among the ends of documents and sentences so that the
padding, plus a penalty for each border that breaks a document, is least:

    best(j) = penalty(j) + min over i in [j - LENGTH, j) of best(i) + LENGTH - (j - i)

The minimum slides with j, so a monotone queue gives it in constant time. A window whose
length is a power of two is not padded, which adds a transition for each power. Where a
sentence leaves no border within reach, borders are added inside it.

Tokens are those of a public tokenizer whose file is a parameter; `end_id` closes each
document. A null text is empty and packs as its closing token alone.

Edge cases: rows that repeat a doc_id, or have none, are packed one by one (nulls first,
by text). An empty table gives an empty result. A document longer than a sequence takes
as many pieces as it needs. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import batch, kept, keyed

LENGTH = 4096
END_ID = 2
#: Cost of a border, in tokens of padding: at the end of a sentence, and inside one.
SENTENCE_COST = 4.0
INSIDE_COST = 16.0
#: Cost of a sequence of its own, so that powers of two are not used to make crumbs.
SEQUENCE_COST = 8.0
#: Tokens of a range that are packed at once.
WINDOW = 1 << 20


def public_file(name: str = "word_bpe_49k.json") -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Characters whose lower case depends on their neighbours or that normalisation may change.
_UNSAFE = re.compile("[\u0130\u0250-\U0010ffff]")
#: Runs of letters that stay one word for the tokenizer.
_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def runs_of(text: str) -> list[str]:
    """A text's runs of characters without white space, made alike where the ids stay the same.

    Letters are lowered where that is what the tokenizer does to them, and a full stop or
    comma after a letter or digit of ASCII becomes a run of its own, as it becomes a token.
    """
    text = text.replace("\n", " ").replace("\t", " ") + " "
    if "<|" not in text and (text.isascii() or not _UNSAFE.search(text)):
        text = text.lower()
    for mark in (". ", ", "):
        if mark in text:
            parts = text.split(mark)
            apart = " " + mark
            last = parts.pop()
            # Only behind a letter of ASCII: others may be taken apart into a letter and a mark, which joins the stop.
            text = "".join([p + (apart if p[-1:].isalnum() and p[-1] < "\x80" else mark) for p in parts]) + last
    return text.split(" ")


class Encoder:
    """Token ids and sentence ends of texts.

    The tokenizer of this file looks at runs of characters without white space one by one,
    so each different run is encoded once and remembered. New runs are encoded in one call:
    those that are one word of letters with spaces between them, as the last token of a word
    says so by its suffix; others with the file's first special token between them, which
    ends a run wherever it stands.
    """

    #: Runs to remember; when there are more, all are forgotten.
    MOST = 1_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.border = min(added) if added else None
        self.mark = str(added[self.border]) if added else ""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.first = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int64)
        self.stop = np.zeros(1 << 16, dtype=bool)
        self.ids = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, and their number by word."""
        texts = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable([e.ids for e in found]), dtype=np.uint32)
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)

    def _learn(self, runs: list[str]) -> None:
        words = [r for r in runs if _WORD.fullmatch(r)]
        flat, lengths = self._words(words)
        if len(lengths) != len(words):  # a tokenizer without such suffixes
            words, flat, lengths = [], flat[:0], lengths[:0]
        known = set(words)
        plain = [r for r in runs if r not in known and not (self.mark and self.mark in r)] if self.mark else []
        known.update(plain)
        if plain:
            found = np.array(self._encode(self.mark.join(plain)), dtype=np.uint32)
            edges = np.flatnonzero(found == self.border)
            lengths = np.concatenate([lengths, np.diff(edges, prepend=-1, append=len(found)) - 1])
            flat = np.concatenate([flat, found[found != self.border]])
        odd = [r for r in runs if r not in known]
        lists = [np.array(self._encode(r), dtype=np.uint32) for r in odd]
        runs = words + plain + odd
        base = len(self.number)
        lengths = np.concatenate([lengths, np.array([len(x) for x in lists], dtype=np.int64)])
        flat = np.concatenate([flat, *lists])
        while len(self.first) < base + len(runs):
            self.first, self.length, self.stop = (np.concatenate([v, np.zeros_like(v)]) for v in (self.first, self.length, self.stop))
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.first[base : base + len(runs)] = self.used + np.cumsum(lengths) - lengths
        self.length[base : base + len(runs)] = lengths
        self.stop[base : base + len(runs)] = [r[-1:] in _STOPS for r in runs]
        self.used += len(flat)
        self.number.update(zip(runs, range(base, base + len(runs))))

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _numbers(self, runs: list[str]) -> np.ndarray:
        """The number of each run, -1 for one that is not known."""
        return np.fromiter(map(self.number.get, runs, repeat(-1)), dtype=np.int64, count=len(runs))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the positions after which a sentence ends."""
        split = [runs_of(t) for t in texts]
        flat = list(chain.from_iterable(split))
        runs = self._numbers(flat)
        missing = np.flatnonzero(runs < 0)
        if len(missing):
            new = {flat[i] for i in missing.tolist()}
            if len(self.number) + len(new) > self.MOST:
                self._forget()
                self._learn(sorted(set(flat)))
                runs = self._numbers(flat)
            else:
                self._learn(sorted(new))
                runs[missing] = self._numbers([flat[i] for i in missing.tolist()])
        length, stop = self.length[runs], self.stop[runs]
        after = np.cumsum(length)
        ids = self.ids[np.arange(after[-1] if len(after) else 0) + np.repeat(self.first[runs] - after + length, length)]
        bounds = np.cumsum([0, *map(len, split)])
        out = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            begin = int(after[a] - length[a])
            out.append((ids[begin : int(after[b - 1])], after[a:b][stop[a:b]] - begin))
        return out


_STOPS = frozenset(".!?")


@dataclass
class Stream:
    """Tokens of consecutive documents and what their borders cost."""

    n: int
    borders: np.ndarray  # increasing positions in (0, n], the last is n
    costs: np.ndarray


def with_inner_borders(borders: np.ndarray, costs: np.ndarray, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders so dense that one is always within reach of `length`."""
    edges = np.concatenate([[0], borders, [] if len(borders) and borders[-1] == n else [n]]).astype(np.int64)
    gaps = np.diff(edges)
    wide = np.flatnonzero(gaps > length // 64)
    if not len(wide):
        return borders, costs
    step = max(1, length // 256)
    extra = np.concatenate([np.arange(edges[i] + step, edges[i + 1], step) for i in wide])
    at = np.concatenate([borders, extra])
    cost = np.concatenate([costs, np.full(len(extra), INSIDE_COST)])
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def choose(stream: Stream, length: int = LENGTH) -> list[int]:
    """The borders of the windows, ending with stream.n; total cost is least.

    Powers of two are tried for borders within `length` of the end, where a stream leaves a
    window that its borders cannot fill.
    """
    at = [0, *stream.borders.tolist()]
    cost = [0.0, *(stream.costs + SEQUENCE_COST).tolist()]
    tail = int(np.searchsorted(stream.borders, stream.n - length)) + 1
    where = {p: i for i, p in enumerate(at) if i >= tail - 1 or p >= stream.n - 2 * length}
    powers = [1 << b for b in range(length.bit_length()) if 1 << b < length]
    best = [0.0] * len(at)
    back = [0] * len(at)
    # Borders with rising best + position; the first in reach is the best to come from.
    queue: list[int] = []
    keys: list[float] = []
    head = 0
    for j in range(1, len(at)):
        here = at[j]
        i = j - 1
        key = best[i] + at[i]
        while len(queue) > head and keys[-1] >= key:
            queue.pop()
            keys.pop()
        queue.append(i)
        keys.append(key)
        while at[queue[head]] < here - length:
            head += 1
        i = queue[head]
        least = keys[head] + length - here
        if j >= tail:
            for p in powers:
                other = where.get(here - p)
                if other is not None and best[other] < least:
                    least, i = best[other], other
        best[j] = least + cost[j]
        back[j] = i
        if head > 4096:
            queue, keys, head = queue[head:], keys[head:], 0
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


_PIECES = "k long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, local long, offset long, ids binary"


def _pack(path: str, end_id: int, length: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents of one range, in order -> their pieces, with the sequence's number in the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("packing", path), lambda: Encoder(path))
        held: list[tuple] = []  # k, doc_id, ids not yet packed, ends in them, start, tokens of the document
        size = number = 0

        def flush(everything: bool) -> Iterator[pa.RecordBatch]:
            """Pack what is held; unless it is the end, the last windows stay open for what comes."""
            nonlocal held, size, number
            if not size:
                return
            lengths = np.array([len(h[2]) for h in held], dtype=np.int64)
            stops = np.cumsum(lengths)
            inner = [h[3] + a for h, a in zip(held, stops - lengths)]
            at = np.concatenate([np.concatenate(inner), stops])
            cost = np.concatenate([np.full(len(at) - len(stops), SENTENCE_COST), np.zeros(len(stops))])
            order = np.lexsort((cost, at))
            at, cost = at[order], cost[order]
            new = (at > 0) & np.append(True, at[1:] != at[:-1])
            at, cost = with_inner_borders(at[new], cost[new], size, length)
            if everything:  # any border may help to end with lengths that need no padding
                free = np.setdiff1d(np.arange(max(1, size - length), size), at)
                at, cost = np.concatenate([at, free]), np.concatenate([cost, np.full(len(free), INSIDE_COST)])
                order = np.argsort(at, kind="stable")
                at, cost = at[order], cost[order]
            windows = choose(Stream(size, at, cost), length)
            if not everything and len(windows) > 8:
                windows = windows[:-8]
            ids = np.concatenate([h[2] for h in held])
            rows = {c: [] for c in ("k", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "local", "offset", "ids")}
            doc = begin = 0
            for end in windows:
                position = begin
                while position < end:
                    while stops[doc] <= position:
                        doc += 1
                    upto = min(end, int(stops[doc]))
                    k, doc_id, _, _, start, tokens = held[doc]
                    piece = ids[position:upto].astype("<u4").tobytes()
                    rows["k"].append(k)
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(start + position - int(stops[doc] - lengths[doc]))
                    rows["length"].append(upto - position)
                    rows["ids_crc32"].append(zlib.crc32(piece))
                    rows["doc_tokens"].append(tokens)
                    rows["local"].append(number)
                    rows["offset"].append(position - begin)
                    rows["ids"].append(piece if keep_ids else None)
                    position = upto
                number += 1
                begin = end
            left = []
            for h, stop, n in zip(held, stops.tolist(), lengths.tolist()):
                done = max(0, begin - (stop - n))
                if done < n:
                    k, doc_id, own, ends, start, tokens = h
                    left.append((k, doc_id, own[done:], ends[ends > done] - done, start + done, tokens))
            held, size = left, size - begin
            yield batch({c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in rows.items()})

        for rows in batches:
            k, doc_id = rows.column("k").to_pylist(), rows.column("doc_id").to_pylist()
            texts = rows.column("text")
            for first in range(0, rows.num_rows, 128):
                part = [t or "" for t in texts.slice(first, 128).to_pylist()]
                for i, (ids, ends) in enumerate(encoder.encode(part)):
                    ids = np.append(ids, np.uint32(end_id))
                    held.append((k[first + i], doc_id[first + i], ids, ends, 0, len(ids)))
                    size += len(ids)
                    if size >= WINDOW:
                        yield from flush(False)
        yield from flush(True)

    return run


def pieces(documents: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece of a document.

    With keep_ids the pieces' ids follow, as little-endian unsigned 32-bit integers.
    """
    docs = keyed(documents).select("k", F.col("doc_id").cast("long"), "text")
    ranges = docs.repartitionByRange("k").sortWithinPartitions("k")
    packed = ranges.mapInArrow(_pack(path or public_file(), end_id, length, keep_ids), _PIECES)
    # A range's first key is its own, so numbers are unique; a range has fewer sequences than tokens.
    numbered = packed.withColumn("sequence_id", F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("local"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return numbered.select(*names, *(["ids"] if keep_ids else []))
