"""Exact Jaccard self-join on word shingles, with skipping by set relations.

Two documents are linked when the Jaccard similarity of their sets of five-word shingles
is `percent` or more. Classes of linked documents are found without writing out the
links inside a group of copies:

1. Equal sets are merged by a 128-bit digest; from here on a set stands for its copies.
2. Sets that agree on most of a few minimum hashes are compared with one leader, and if
   that is in vain with another. A set linked to its leader is a follower: how many
   shingles they share is now known.
3. An inverted index over the prefixes of all sets (rare shingles first) gives candidate
   pairs. Its lists are sorted and cut into blocks; a pair of blocks is skipped whole when
   their sizes or positions leave too little overlap, or when all their sets already are
   in one class. A set's postings in a bucket share a bitmap of the whole set: the
   parity of the set's shingles in each of its places, BITS at least, more for larger sets. Where two bitmaps differ an odd number of shingles
   stands in one set only, so d different bits leave an overlap of (na + nb - d) / 2 at
   most; pairs for which that is too little go before they are written. Lists of very
   common shingles are dealt out in cells.
4. A candidate pair is answered from its leaders first: the overlap of two followers
   differs from that of their leaders by no more than the shingles in which they differ
   from these. Only pairs that this leaves open are compared themselves.
5. Components of all links are the classes.

No link between different sets is lost: a pair is skipped only if it cannot be linked or
if both sets are in one class already. Shingles are 64-bit hashes.

Edge cases: text that is null or has no words has an empty set, linked with nothing, not
even with other empty ones. Rows that repeat a doc_id, or have none, are documents of
their own; the least doc_id that is not null names the class. An empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import batch, discard, forget, give_back, ints, keyed, longs, materialize, small_batches
from threadsift.llm.components import components
from threadsift.llm.hashing import blocks, mix, shingles, words_of

SHINGLE = 5
PERCENT = 80
#: Minimum hashes by which a set looks for a leader, and how many must name it.
HASHES = 8
VOTES = 4
#: Leaders that a set may ask in turn.
ROUNDS = 3
#: Most common shingles that are put last in the order of prefixes; a matter of speed only.
COMMON = 100_000
#: Postings in a bucket of the index, on average, and sets in a cell of a common shingle's list.
BUCKET = 200_000
CELL = 20_000
BLOCK = 64
#: Places of a set's bitmap at least and at most, powers of two in words of 64 bits, and words for which a posting pays.
BITS = 4 * 64
MOST_BITS = 128 * 64
PAID = 8
#: Candidate pairs that are held to be merged, pairs that are looked at together, and pairs of bitmaps.
STEP = 1 << 20
PAIRS = 1 << 18
AT_ONCE = 1 << 15
#: Sets whose postings are packed together.
PACK = 1000


def _sets_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, shingles) of blocks of texts: sorted distinct hashes of each text."""
    for block in blocks(texts):
        values, bounds = shingles(words_of(block, lower=True), SHINGLE)
        text = np.repeat(np.arange(len(block)), np.diff(bounds))
        order = np.lexsort((values, text))
        values, text = values[order], text[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
        values, text = values[new], text[new]
        yield block.first, np.searchsorted(text, np.arange(len(block) + 1)), values


def _sets(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, bounds, shingles) of blocks of documents."""
    k = rows.column("k").to_numpy(zero_copy_only=False)
    for first, bounds, values in _sets_of(rows.column("text")):
        yield k[first : first + len(bounds) - 1], bounds, values


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that three or more sets of one block hold, with their number."""
    forget()
    for rows in batches:
        for _, _, values in _sets(rows):
            shingle, n = np.unique(values, return_counts=True)
            many = n > 2
            if many.any():
                yield batch({"shingle": longs(shingle[many]), "n": pa.array(n[many].astype(np.int64))})


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles, sorted, and how many sets hold them (about); at most COMMON."""
    found = docs.select("k", "text").mapInArrow(_often, "shingle long, n long")
    top = found.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(COMMON).toPandas()
    shingle = top.shingle.to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], top.n.to_numpy(dtype=np.int64)[order]


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def bitmaps(values: np.ndarray, bounds: np.ndarray, places: int = BITS) -> np.ndarray:
    """For each set its bitmap of `places` bits, places / 64 words."""
    sets = len(bounds) - 1
    out = np.zeros((sets, places // 64), dtype=np.uint64)
    step = max(1, STEP // places)
    for a in range(0, sets, step):
        b = min(a + step, sets)
        row = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
        place = (mix(values[bounds[a] : bounds[b]], 61) % np.uint64(places)).astype(np.int64)
        odd = (np.bincount(row * places + place, minlength=(b - a) * places) & 1).astype(np.uint8)
        out[a:b] = np.packbits(odd.reshape(-1, places), axis=1, bitorder="little").view(np.uint64)
    return out


def _bitmaps_by_size(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each set a bitmap of about twice as many places as it has shingles."""
    n = np.diff(bounds)
    places = np.clip(2 ** np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64), BITS, MOST_BITS)
    out = [b""] * len(n)
    for size in np.unique(places).tolist():
        rows = np.flatnonzero(places == size)
        part = np.concatenate([values[bounds[i] : bounds[i + 1]] for i in rows.tolist()])
        for i, bits in zip(rows.tolist(), bitmaps(part, np.append(0, np.cumsum(n[rows])), size)):
            out[i] = bits.tobytes()
    return out


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) brought down to fewer places: each takes the parity of those that fall on it."""
    return bits if bits.shape[1] == words else np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


class Bitmaps:
    """Bitmaps of different lengths, compared in the shorter length of two; `entry` names each posting's."""

    def __init__(self, flat: np.ndarray, words: np.ndarray, entry: np.ndarray):
        self.flat, self.words, self.entry = flat, words.astype(np.int64), entry
        self.starts = np.cumsum(self.words) - self.words

    def take(self, postings: np.ndarray) -> Bitmaps:
        return Bitmaps(self.flat, self.words, self.entry[postings])

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In how many places the bitmaps of two postings differ."""
        x, y = self.entry[left], self.entry[right]
        level = self.words[x] * 1000 + self.words[y]
        out = np.zeros(len(x), dtype=np.int64)
        for pair in np.unique(level).tolist():
            p, q = divmod(pair, 1000)
            if not (p and q):
                continue
            here = np.flatnonzero(level == pair)
            step = max(1, AT_ONCE * 4 // max(p, q))
            for i in range(0, len(here), step):
                part = here[i : i + step]
                a = _folded(self.flat[self.starts[x[part]][:, None] + np.arange(p)], min(p, q))
                b = _folded(self.flat[self.starts[y[part]][:, None] + np.arange(q)], min(p, q))
                out[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        return out


_SKETCH = "k long, n int, digest long, digest2 long, least array<long>, prefix binary, bits binary"


def _sketches(common: np.ndarray, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for rows in batches:
            for k, bounds, values in _sets(rows):
                n = np.diff(bounds)
                text = np.repeat(np.arange(len(n)), n)
                full = np.flatnonzero(n)
                digests, least = [], []
                for seed in (31, 32):
                    total = np.zeros(len(n), dtype=np.uint64)
                    if len(full):
                        total[full] = np.add.reduceat(mix(values, seed), bounds[full])
                    digests.append(longs(total))
                for seed in range(HASHES):
                    low = np.zeros(len(n), dtype=np.uint64)
                    if len(full):
                        low[full] = np.minimum.reduceat(mix(values, 40 + seed), bounds[full])
                    least.append(low)
                order = np.lexsort((values, _member(common, values), text))
                raw = values[order]
                length = n - -(-n * percent // 100) + 1
                prefixes = [raw[a : a + c].tobytes() if m else b"" for a, c, m in zip(bounds, length, n)]
                flat = np.stack(least, axis=1).ravel() if len(n) else np.zeros(0, dtype=np.uint64)
                yield batch(
                    {
                        "k": pa.array(k),
                        "n": ints(n),
                        "digest": digests[0],
                        "digest2": digests[1],
                        "least": pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * HASHES, pa.int32()), longs(flat)),
                        "prefix": pa.array(prefixes, pa.binary()),
                        "bits": pa.array(_bitmaps_by_size(values, bounds), pa.binary()),
                    }
                )

    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts -> the sizes of their sets and of what they share."""
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            rows = whole.slice(first, 256)
            sides = []
            for name in ("ta", "tb"):
                sides.append([v[a:b] for _, bounds, v in _sets_of(rows.column(name)) for a, b in zip(bounds, bounds[1:])])
            shared = [int(_member(y, x).sum()) if len(x) < len(y) else int(_member(x, y).sum()) for x, y in zip(*sides)]
            yield batch(
                {
                    "a": rows.column("a"),
                    "b": rows.column("b"),
                    "na": pa.array(list(map(len, sides[0])), pa.int32()),
                    "nb": pa.array(list(map(len, sides[1])), pa.int32()),
                    "shared": pa.array(shared, pa.int32()),
                }
            )


def overlaps(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb, shared) for each pair of documents, from their whole texts; pairs must be a written table."""
    ids = materialize(pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct())
    texts = materialize(docs.select("k", "text").join(ids, "k", "left_semi"))
    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("k").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("k").alias("b"), F.col("text").alias("tb")), "b")
    )
    counted = both.select("a", "b", "ta", "tb").mapInArrow(_count_shared, "a long, b long, na int, nb int, shared int")
    counted = materialize(counted)
    discard(texts)
    return counted


def _linked(percent: int) -> str:
    return f"100 * CAST(shared AS LONG) >= {percent} * (CAST(na AS LONG) + nb - shared)"


def leader_pairs(sketches: DataFrame, asking: DataFrame, round_: int) -> DataFrame:
    """(a, b): each asking set and the set that most of its minimum hashes name, VOTES at least.

    Each minimum hash names one of the sets that have it: the least in round 0, in later
    rounds the one with the least salted hash.
    """
    least = sketches.select("k", F.posexplode("least").alias("slot", "value"))
    rank = F.col("k") if round_ == 0 else F.xxhash64("k", F.lit(round_))
    named = materialize(
        least.groupBy("slot", "value")
        .agg(F.min_by("k", rank).alias("leader"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1")
        .select("slot", "value", "leader")
    )
    asked = asking.select("k", F.posexplode("least").alias("slot", "value"))
    votes = asked.join(named, ["slot", "value"]).groupBy("k", "leader").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.filter(f"votes >= {VOTES} AND leader <> k").groupBy("k").agg(
        F.max(F.struct("votes", (-F.col("leader")).alias("leader"))).alias("best")
    )
    return best.select(F.col("k").alias("a"), (-F.col("best.leader")).alias("b"))


def followers(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, shared): sets that are linked to a leader, one leader for each.

    A set that the first leader turns away asks others in later rounds; every round
    compares a set once.
    """
    found = None
    asking = sets
    for round_ in range(ROUNDS):
        linked = overlaps(docs, materialize(leader_pairs(sets, asking, round_))).filter(_linked(percent))
        found = linked if found is None else found.unionByName(linked)
        asking = asking.join(linked.select(F.col("a").alias("k")), "k", "left_anti")
    return found


#: Of each posting: shingle, place in its prefix, marks and entry; of each entry, a set in a bucket, the others.
_POSTINGS = (
    "bucket long, cell int, shingle binary, at binary, marks binary, entry binary, "
    "k binary, n binary, class binary, able binary, words binary, bits binary"
)
_TYPES = {
    "shingle": np.uint64, "at": np.int32, "marks": np.uint8, "entry": np.int32,
    "k": np.int64, "n": np.int32, "class": np.int64, "able": np.int32, "words": np.uint8, "bits": np.uint64,
}
#: Marks of a posting: its shingle is a common one; its set has common ones in its prefix.
_COMMON, _SUSPECT = 1, 2


def _paid_bitmaps(bits: pa.Array, row: np.ndarray, set_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each entry's bitmap, and all of them; a set's is as long as its postings in a bucket pay for."""
    raw = bits.to_pylist()
    whole = np.array([len(b) // 8 for b in raw], dtype=np.int64)
    paid = PAID * np.bincount(row, minlength=len(raw)) / np.maximum(np.bincount(set_, minlength=len(raw)), 1)
    words = np.minimum(whole, 2 ** np.log2(np.maximum(paid, BITS // 64)).astype(np.int64))
    size = words[set_]
    starts = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), dtype=np.uint64)
    for i in range(len(raw)):
        raw[i] = _folded(np.frombuffer(raw[i], dtype=np.uint64).reshape(1, -1), int(words[i]))[0]
    for w in np.unique(size).tolist():
        entries = np.flatnonzero(size == w)
        sets, which = np.unique(set_[entries], return_inverse=True)
        flat[starts[entries][:, None] + np.arange(w)] = np.stack([raw[i] for i in sets.tolist()])[which]
    return size, flat


def _postings(common: np.ndarray, often: np.ndarray, buckets: int, cell: int, with_bits: bool):
    """Postings of prefixes, packed by bucket; a common shingle's go to every cell that pairs its part with another."""
    parts_of = np.maximum(1, -(-often // cell))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (b.slice(i, PACK) for b in batches for i in range(0, b.num_rows, PACK)):
            k = rows.column("k").to_numpy()
            n = rows.column("n").to_numpy()
            class_ = rows.column("class").to_numpy()
            raw = rows.column("prefix").to_pylist()
            lengths = np.fromiter((len(p) // 8 for p in raw), dtype=np.int64, count=len(raw))
            shingle = np.frombuffer(b"".join(raw), dtype=np.uint64)
            row = np.repeat(np.arange(len(k)), lengths)
            is_common = _member(common, shingle)
            n_common = np.bincount(row, weights=is_common, minlength=len(k)).astype(np.int32)
            able = np.where(n_common > 0, n_common + rows.column("meeting").to_numpy(), lengths).astype(np.int32)
            at = (np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            bucket = (shingle % np.uint64(buckets)).astype(np.int64)
            cells = np.full(len(row), -1, dtype=np.int32)
            if len(common) and (parts_of > 1).any():
                where = np.minimum(np.searchsorted(common, shingle), len(common) - 1)
                parts = np.where(common[where] == shingle, parts_of[where], 1)
                split = np.flatnonzero(parts > 1)
                if len(split):
                    # Part s of p meets part t in cell (least, greatest); the bucket is the shingle's own.
                    each = np.repeat(split, parts[split])
                    p = parts[each]
                    other = np.arange(len(each)) - np.repeat(np.cumsum(parts[split]) - parts[split], parts[split])
                    own = (mix(k[row[each]].view(np.uint64), 51) % p.astype(np.uint64)).astype(np.int64)
                    keep = np.flatnonzero(parts == 1)
                    row, at, shingle = (np.concatenate([v[keep], v[each]]) for v in (row, at, shingle))
                    bucket = np.concatenate([bucket[keep], buckets + (shingle[len(keep) :] >> np.uint64(2)).astype(np.int64)])
                    cells = np.concatenate([cells[keep], (np.minimum(own, other) * 30_000 + np.maximum(own, other)).astype(np.int32)])
            order = np.lexsort((shingle, row, cells, bucket))
            bucket, cells, row, at, shingle = (v[order] for v in (bucket, cells, row, at, shingle))
            marks = (_COMMON * _member(common, shingle) + _SUSPECT * (n_common[row] > 0)).astype(np.uint8)
            new = np.ones(len(row), dtype=bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (cells[1:] != cells[:-1])
            fresh = new.copy()
            fresh[1:] |= row[1:] != row[:-1]
            first, heads = np.flatnonzero(new), np.flatnonzero(fresh)
            set_, number = row[heads], np.cumsum(fresh) - 1
            spans = list(zip(first.tolist(), [*first[1:].tolist(), len(row)]))
            held = np.append(number[first], len(heads))
            entry = (number - np.repeat(held[:-1], np.diff(np.append(first, len(row))))).astype(np.int32)
            words, flat = _paid_bitmaps(rows.column("bits"), row, set_) if with_bits else (np.zeros(len(set_), np.int64), np.zeros(0, np.uint64))
            at_word = np.append(0, np.cumsum(words))[held]
            of_posting = {"shingle": shingle, "at": at, "marks": marks, "entry": entry}
            of_entry = {"k": k[set_], "n": n[set_].astype(np.int32), "class": class_[set_], "able": able[set_], "words": words.astype(np.uint8)}
            yield batch(
                {"bucket": pa.array(bucket[first]), "cell": pa.array(cells[first])}
                | {c: pa.array([v[a:b].tobytes() for a, b in spans], pa.binary()) for c, v in of_posting.items()}
                | {c: pa.array([v[a:b].tobytes() for a, b in zip(held, held[1:])], pa.binary()) for c, v in of_entry.items()}
                | {"bits": pa.array([flat[a:b].tobytes() for a, b in zip(at_word, at_word[1:])], pa.binary())}
            )

    return run


def _needed(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of two sets that makes a link."""
    return -(-percent * (na.astype(np.int64) + nb) // (100 + percent))


def _pairs_in_range(n, at, class_, able, bits, left, right, percent):
    """Candidate pairs among given index pairs.

    Sizes, positions and bitmaps leave enough overlap, both sets can meet as often as they
    must, and their classes differ.
    """
    n1, n2, p1, p2 = n[left], n[right], at[left], at[right]
    needed = _needed(n1, n2, percent)
    good = (np.minimum(p1, p2) + np.minimum(n1 - p1, n2 - p2) >= needed) & (class_[left] != class_[right])
    follows = -(-np.maximum(n1, n2) * percent // 100) - 1
    good &= np.minimum(able[left], able[right]) + follows >= needed
    left, right, needed = left[good], right[good], needed[good]
    good = np.zeros(len(left), dtype=bool)
    for a in range(0, len(left), AT_ONCE):
        x, y = left[a : a + AT_ONCE], right[a : a + AT_ONCE]
        good[a : a + AT_ONCE] = n[x] + n[y] - bits.apart(x, y) >= 2 * needed[a : a + AT_ONCE]
    return left[good], right[good]


def _short_lists(bounds: np.ndarray, n, at, class_, able, bits, percent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the lists [bounds[i], bounds[i + 1]), a bounded number at a time."""
    lengths = np.diff(bounds)
    lengths, begins = lengths[lengths > 1], bounds[:-1][lengths > 1]
    many = lengths * lengths
    cut = 0
    while cut < len(many):
        end = max(cut + 1, int(np.searchsorted(np.cumsum(many[cut:]), PAIRS)) + cut)
        m, b = lengths[cut:end], begins[cut:end]
        which = np.repeat(np.arange(len(m)), m * m)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(m * m) - m * m, m * m)
        i, j = inner // m[which], inner % m[which]
        half = i < j
        yield _pairs_in_range(n, at, class_, able, bits, (b[which] + i)[half], (b[which] + j)[half], percent)
        cut = end


def _long_list(lo: int, hi: int, n, at, class_, able, bits, percent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one long list by pairs of blocks; blocks that cannot hold a link are skipped whole."""
    starts = np.arange(lo, hi, BLOCK)
    low_n, high_n = np.minimum.reduceat(n[:hi], starts), np.maximum.reduceat(n[:hi], starts)
    rest = np.maximum.reduceat((n - at)[:hi], starts)
    high_p = np.maximum.reduceat(at[:hi], starts)
    low_c, high_c = np.minimum.reduceat(class_[:hi], starts), np.maximum.reduceat(class_[:hi], starts)
    for i, a in enumerate(starts.tolist()):
        j = np.arange(i, len(starts))
        most = np.minimum(high_p[i], high_p[j]) + np.minimum(rest[i], rest[j])
        fits = (low_n[j] * percent <= high_n[i] * 100) & (low_n[i] * percent <= high_n[j] * 100)
        fits &= most >= _needed(np.full(len(j), low_n[i]), low_n[j], percent)
        fits &= ~((low_c[i] == high_c[i]) & (low_c[j] == high_c[j]) & (low_c[i] == low_c[j]))
        x = np.arange(a, min(a + BLOCK, hi))
        for b in starts[j[fits]].tolist():
            y = np.arange(b, min(b + BLOCK, hi))
            left, right = np.repeat(x, len(y)), np.tile(y, len(x))
            if a == b:
                half = left < right
                left, right = left[half], right[half]
            yield _pairs_in_range(n, at, class_, able, bits, left, right, percent)


def _merged_pairs(pairs: np.ndarray) -> np.ndarray:
    """Rows (a, b, na, nb, met) with one row for each pair, its meetings summed."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    first = np.flatnonzero(np.append(True, (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)))
    merged = pairs[first]
    merged[:, 4] = np.add.reduceat(pairs[:, 4], first)
    return merged


def _unpacked(parts: list[dict], of_posting: tuple[str, ...], of_entry: tuple[str, ...]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Columns of all postings of a bucket, and the entry of each."""
    before = np.cumsum([0, *(len(p["k"]) for p in parts)])
    entry = np.concatenate([p["entry"] + b for p, b in zip(parts, before)])
    out = {c: np.concatenate([p[c] for p in parts]) for c in of_posting}
    return out | {c: np.concatenate([p[c] for p in parts])[entry] for c in of_entry}, entry


def _probe(percent: int):
    """Packed postings, sorted by bucket and cell -> candidate pairs of each, with how often they meet."""

    def of_bucket(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        whole, entry = _unpacked(parts, ("shingle", "at"), ("k", "n", "class", "able"))
        # In a list: by class, then size and position, so that blocks are alike.
        order = np.lexsort((whole["at"], whole["n"], whole["class"], whole["shingle"]))
        shingle, k, n, at, class_, able = (whole[c][order] for c in ("shingle", "k", "n", "at", "class", "able"))
        bits = Bitmaps(np.concatenate([p["bits"] for p in parts]), np.concatenate([p["words"] for p in parts]), entry[order])
        n, at = n.astype(np.int64), at.astype(np.int64)
        bounds = np.append(np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1])), len(shingle))
        long_ = np.flatnonzero(np.diff(bounds) > 4 * BLOCK)
        short = np.diff(bounds) <= 4 * BLOCK
        # Long lists are cut out of the short ones by giving them no length.
        begins, ends = bounds[:-1][short], bounds[1:][short]

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if len(begins):
                packed = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends)]) if len(long_) else np.arange(len(shingle))
                inner = np.append(0, np.cumsum(ends - begins))
                for x, y in _short_lists(inner, n[packed], at[packed], class_[packed], able[packed], bits.take(packed), percent):
                    yield packed[x], packed[y]
            for i in long_.tolist():
                yield from _long_list(int(bounds[i]), int(bounds[i + 1]), n, at, class_, able, bits, percent)

        def out(pairs: np.ndarray) -> pa.RecordBatch:
            names = zip(("a", "b", "na", "nb", "met"), pairs.T)
            return batch({c: pa.array(np.ascontiguousarray(v)) for c, v in names})

        held: list[np.ndarray] = []
        size = 0
        for x, y in found():
            if not len(x):
                continue
            up = k[x] > k[y]
            x, y = np.where(up, x, y), np.where(up, y, x)
            held.append(np.stack([k[x], k[y], n[x], n[y], np.ones(len(x), dtype=np.int64)], axis=1))
            size += len(x)
            if size > STEP:
                held = [_merged_pairs(np.concatenate(held))]
                size = 0
                if len(held[0]) > STEP:
                    yield out(held[0])
                    held = []
        if held:
            yield out(_merged_pairs(np.concatenate(held)))

    return _whole_buckets(of_bucket)


def _meetings(parts: list[dict]) -> Iterator[pa.RecordBatch]:
    """How many of a suspect set's shingles in this bucket, common ones aside, another set has too."""
    whole, _ = _unpacked(parts, ("shingle", "marks"), ("k",))
    shingle, k, marks = whole["shingle"], whole["k"], whole["marks"]
    _, number, times = np.unique(shingle, return_inverse=True, return_counts=True)
    keys, n = np.unique(k[(marks == _SUSPECT) & (times[number] > 1)], return_counts=True)
    if len(keys):
        yield batch({"k": pa.array(keys), "meeting": pa.array(n.astype(np.int64))})


def _whole_buckets(work: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Calls `work` with all packed postings of a bucket and cell; rows come sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for rows in batches:
            bucket, cell = rows.column("bucket").to_pylist(), rows.column("cell").to_pylist()
            for i in range(rows.num_rows):
                if at != (bucket[i], cell[i]):
                    if held:
                        yield from work(held)
                    at, held = (bucket[i], cell[i]), []
                held.append({c: np.frombuffer(rows.column(c)[i].as_buffer(), dtype=t) for c, t in _TYPES.items()})
        if held:
            yield from work(held)
        held = []
        give_back()

    return run


def candidates(sets: DataFrame, common: np.ndarray, often: np.ndarray, percent: int) -> DataFrame:
    """Candidate pairs (a, b, na, nb) of sets of different classes; sets: k, n, prefix, class.

    Let x be the set whose prefix ends first. What two sets share up to that end stands in
    both prefixes, where they meet once for each such shingle; the rest is no more than
    what follows in x, ceil(percent * n) - 1. Pairs for which that is too little go.

    Sets with common shingles in their prefix meet very many others there. For them it is
    counted first how many of their other shingles stand in any second prefix: a set that
    cannot meet another one often enough is not paired at all.
    """
    total = sets.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    buckets = max(64, int(total // BUCKET))

    def dealt(rows: DataFrame, with_bits: bool) -> DataFrame:
        packed = rows.select("k", "n", "prefix", "class", "meeting", "bits").mapInArrow(
            _postings(common, often, buckets, CELL, with_bits), _POSTINGS
        )
        return packed.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")

    counted = dealt(sets.withColumn("meeting", F.lit(0)), False).mapInArrow(_whole_buckets(_meetings), "k long, meeting long")
    meeting = materialize(counted.groupBy("k").agg(F.sum("meeting").cast("int").alias("meeting")))
    ready = sets.join(meeting, "k", "left").withColumn("meeting", F.coalesce("meeting", F.lit(0)))
    met = dealt(ready, True).mapInArrow(_probe(percent), "a long, b long, na long, nb long, met long")
    pairs = met.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("met").alias("met"))
    follows = F.ceil(F.greatest("na", "nb") * percent / 100) - 1
    return pairs.filter((F.col("met") + follows) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))).select("a", "b", "na", "nb")


def classes(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """k, doc_id, n_shingles, class (least k) for every document of a keyed table."""
    docs = documents
    common, often = common_shingles(docs)
    sketches = materialize(docs.select("k", "text").mapInArrow(_sketches(common, percent), _SKETCH))
    full = sketches.filter("n > 0")
    groups = full.groupBy("digest", "digest2", "n").agg(F.min("k").alias("set"), F.count(F.lit(1)).alias("c"))
    groups = materialize(groups)
    copies = materialize(
        full.join(groups.filter("c > 1"), ["digest", "digest2", "n"]).filter("k <> set").select("k", "set")
    )
    sets = full.join(copies, "k", "left_anti")

    # Followers and their leaders.
    stars = followers(docs, sets.select("k", "least"), percent)
    first = materialize(components(stars.select("a", "b")))
    labelled = sets.join(first.select(F.col("node").alias("k"), F.col("component").alias("class")), "k", "left")
    labelled = labelled.withColumn("class", F.coalesce("class", "k"))
    with small_batches(docs.sparkSession, 10_000, "8m"):
        open_ = materialize(candidates(labelled, common, often, percent))

    # Answers of leaders first, then those of followers that they leave open.
    star = stars.selectExpr("a AS k", "b AS leader", "na - shared AS apart")

    def with_leader(pairs: DataFrame, side: str) -> DataFrame:
        named = star.select(F.col("k").alias(side), F.col("leader").alias(f"l{side}"), F.col("apart").alias(f"d{side}"))
        return pairs.join(named, side, "left").withColumns(
            {f"l{side}": F.coalesce(f"l{side}", side), f"d{side}": F.coalesce(f"d{side}", F.lit(0))}
        )

    led = materialize(with_leader(with_leader(open_.withColumnsRenamed({"na": "n1", "nb": "n2"}), "a"), "b"))
    leading = materialize(
        led.filter("la <> lb").select(F.greatest("la", "lb").alias("a"), F.least("la", "lb").alias("b")).distinct()
    )
    answers = overlaps(docs, leading)
    undecided = (
        led.withColumns({"x": F.greatest("la", "lb"), "y": F.least("la", "lb")})
        .filter("NOT (a = x AND b = y)")
        .join(answers.select(F.col("a").alias("x"), F.col("b").alias("y"), "na", "nb", "shared"), ["x", "y"])
        .filter(f"NOT ({_linked(percent)})")
        .filter(f"100 * CAST(shared + da + db AS LONG) >= {percent} * (n1 + n2 - shared - da - db)")
        .select("a", "b")
        .distinct()
    )
    undecided = materialize(undecided)
    links = stars.select("a", "b").unionByName(answers.filter(_linked(percent)).select("a", "b"))
    if not undecided.isEmpty():
        links = links.unionByName(overlaps(docs, undecided).filter(_linked(percent)).select("a", "b"))
    links = links.unionByName(copies.select(F.col("k").alias("a"), F.col("set").alias("b")))
    named = materialize(components(links))
    return (
        docs.select("k", "doc_id")
        .join(sketches.select("k", F.col("n").cast("long").alias("n_shingles")), "k")
        .join(named.select(F.col("node").alias("k"), F.col("component").alias("class")), "k", "left")
        .withColumn("class", F.coalesce("class", "k"))
    )


def similar(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    with small_batches(documents.sparkSession, 2000, "8m"):
        found = classes(keyed(documents), percent)
    several = found.groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    return found.join(several.select("class", "least"), "class", "left").select(
        F.col("doc_id").cast("long"), "n_shingles", F.coalesce("least", "doc_id").cast("long").alias("component_id")
    )


def representatives(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, without those that are linked to a class named by another one."""
    docs = keyed(documents)
    with small_batches(docs.sparkSession, 2000, "8m"):
        gone = materialize(classes(docs, percent).filter("class <> k").select("k"))
    return docs.join(gone, "k", "left_anti").select("row.*")
