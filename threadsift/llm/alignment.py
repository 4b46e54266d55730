"""Cross-tokenizer alignment: two tokenizers' tokens of the same text, cut where both end.

Tokenizer A is a byte-level BPE of `tokenizers`, B a piece model of `sentencepiece` with
byte fallback. A reads a space and the text; B reads the text and puts the space before
it itself. The spans that the libraries report are the coarse cuts: character offsets of
A, byte spans of B (`return_type="offset_mapping"` with bytes, which in the installed
sentencepiece stands where its immutable protocol buffers stood; that type is refused
now). Where a token is one whole stretch of characters its span is its byte range. Where
several tokens share a character, A reports the whole character for each and B an empty
span for all but the last; there the lengths of the tokens' decoded bytes place the cuts
inside the character. At last the bytes of all tokens are laid out and compared with the
bytes of the text, so a text that B's normalisation changes is found and has no tokens.

From the byte ends of both sides follow the groups (cuts common to A and B) and the
links (one for each stretch between neighbouring cuts of any side, which lies in one
token of A and one of B). All of that is arithmetic on one block of texts at a time.

Neither tokenizer joins anything across some places: before a single space between
characters that are not white space, behind a single line feed between such, and between
a letter of ASCII and a full stop, comma or the like. A's words end there by their
pattern, and no piece of B reaches over such a place (which is checked, for each kind of
place). So a text is cut there, each different part is encoded and aligned once by a task
and remembered, and a document is its parts in order. A text without such places is one
part. In parts of ASCII alone one character is one byte, so the lengths of the tokens are
the cuts and the spans are not asked for.

Documents are encoded once; the links of each are written beside its counts, as one
number for each link. Links are counted in blocks, then by id pair over the corpus. To
give each link its pair's count, pairs that hold more than 1/262,144 of all links (so
fewer than 262,144 pairs) are shipped to the tasks; the links of other pairs are merged
in their document and joined by pair. No pair of the join can be hot.

Edge cases: a null, empty or not aligned text has zeros, and '' as groups. A leading
space, other white space, special tokens' strings, U+2581 and any length are ordinary
text; a document is never cut. Rows that repeat a doc_id, or have none, are documents of
their own. An empty table gives an empty result. Other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import batch, forget, kept, keyed, longs, materialize, small_batches
from threadsift.llm.hashing import blocks

#: Pairs with more than this part of all links are shipped to the tasks; there are fewer than this.
HOT = 1 << 18
BLOCK_BYTES = 1 << 18
#: An id pair as one number: A's id above, B's id in the lower bits.
_B_BITS = 32
_SPACE = "▁"


def public_file(name: str) -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes in order for the
    letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """The bytes of every token: one array of all, and where each token's begin."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        return cls(data, np.cumsum(lengths) - lengths, lengths)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of tokens."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(total)]


@dataclass
class Tokens:
    """Tokens of a block of texts: ids, byte spans in the block as reported, tokens of each text."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


class Side:
    """A tokenizer: tokens with coarse spans, and the bytes of its vocabulary."""

    vocabulary: Vocabulary

    def encode(self, texts: list[str], bounds: np.ndarray, data: np.ndarray) -> Tokens:
        """texts begin with the space; bounds and data are their bytes."""
        if (data < 0x80).all():
            ids, counts = self._ids(texts)
            lengths = self.vocabulary.lengths[ids]
            ends = np.cumsum(lengths)
            # Each text's tokens start with its bytes, whatever those before add up to.
            starts = np.cumsum(counts) - counts
            before = np.concatenate([[0], ends])[starts]
            ends += np.repeat(bounds[:-1] - before, counts)
            return Tokens(ids, ends - lengths, ends, counts)
        return self._with_spans(texts, bounds, data)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and their number by text."""
        raise NotImplementedError

    def _with_spans(self, texts: list[str], bounds: np.ndarray, data: np.ndarray) -> Tokens:
        raise NotImplementedError


class ByteSide(Side):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = _byte_of_letter()
        names = {i: t for t, i in self.tokenizer.get_vocab().items()}
        decoded = [names.get(i, "") for i in range(max(names) + 1)]
        self.vocabulary = Vocabulary.of([bytes(byte.get(c, 0) for c in t) for t in decoded])

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(e) for e in found], dtype=np.int64)
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(counts.sum())), counts

    def _with_spans(self, texts: list[str], bounds: np.ndarray, data: np.ndarray) -> Tokens:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        counts = np.array([len(e) for e in found], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable([e.ids for e in found]), dtype=np.int64, count=int(counts.sum()))
        spans = np.array(list(chain.from_iterable([e.offsets for e in found])), dtype=np.int64).reshape(-1, 2)
        # Offsets count characters of one text: turn them into bytes of the block.
        first_bytes = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        before = np.searchsorted(first_bytes, bounds[:-1])
        shift = np.repeat(before, counts)
        return Tokens(ids, first_bytes[spans[:, 0] + shift], first_bytes[spans[:, 1] + shift], counts)


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.vocabulary = Vocabulary.of([self._bytes(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())])

    @staticmethod
    def _bytes(piece: str) -> bytes:
        fallback = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes.fromhex(fallback[1]) if fallback else piece.replace(_SPACE, " ").encode()

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode([t[1:] for t in texts], return_type="numpy", num_threads=1)
        counts = np.array([len(f) for f in found], dtype=np.int64)
        return np.concatenate([*found, np.zeros(0, dtype=np.int64)]).astype(np.int64), counts

    def _with_spans(self, texts: list[str], bounds: np.ndarray, data: np.ndarray) -> Tokens:
        found = self.model.encode([t[1:] for t in texts], return_type="offset_mapping", return_bytes=True, num_threads=1)
        counts = np.array([len(f["ids"]) for f in found], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable([f["ids"] for f in found]), dtype=np.int64, count=int(counts.sum()))
        spans = np.array(list(chain.from_iterable([f["offsets"] for f in found])), dtype=np.int64).reshape(-1, 2)
        shift = np.repeat(bounds[:-1] + 1, counts)  # spans do not count the space that the model adds
        begins, ends = spans[:, 0] + shift, spans[:, 1] + shift
        firsts = np.cumsum(counts) - counts
        begins[firsts[counts > 0]] -= 1
        return Tokens(ids, begins, ends, counts)


def refined(tokens: Tokens, lengths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte end of every token in the block, and which texts do not fit their tokens.

    A span that begins where the last one ended and is as long as its token's bytes is taken
    as it is. Other tokens follow each other from the last taken end by the lengths of their
    bytes, which must lead to the next taken span, or to the end of the text.
    """
    n = len(tokens.ids)
    sizes = lengths[tokens.ids]
    text = np.repeat(np.arange(len(tokens.counts)), tokens.counts)
    first = np.zeros(n, dtype=bool)
    starts = np.cumsum(tokens.counts) - tokens.counts
    first[starts[tokens.counts > 0]] = True
    coarse_before = np.empty(n, dtype=np.int64)
    coarse_before[1:] = tokens.ends[:-1]
    coarse_before[first] = bounds[:-1][tokens.counts > 0]
    taken = (tokens.begins == coarse_before) & (tokens.ends - tokens.begins == sizes)
    # Bytes from the last taken end on: a running sum that starts anew behind each taken token.
    total = np.cumsum(sizes)
    base = np.where(taken, tokens.ends - total, 0)
    text_base = np.zeros(n, dtype=np.int64)
    text_base[first] = bounds[:-1][tokens.counts > 0] - (total - sizes)[first]
    anchor = np.where(taken | first, np.arange(n), 0)
    anchor = np.maximum.accumulate(anchor) if n else anchor
    ends = total + np.where(taken[anchor], base[anchor], text_base[anchor])
    # A taken token must begin where the one before it ends by its bytes.
    before = np.empty(n, dtype=np.int64)
    before[1:] = ends[:-1]
    before[first] = bounds[:-1][tokens.counts > 0]
    wrong = taken & (before != tokens.begins)
    last = starts + tokens.counts - 1
    closed = np.zeros(len(tokens.counts), dtype=bool)
    some = tokens.counts > 0
    closed[some] = ends[last[some]] == bounds[1:][some]
    bad = ~closed
    bad[text[wrong]] = True
    return ends, bad


def _texts(ids_a: np.ndarray, last_a: np.ndarray, ids_b: np.ndarray, last_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, names: np.ndarray, a_size: int, b_size: int) -> list[str]:
    """The written tokens in order of group, A before B: `1,` inside a list, `1|` and `1;` at its end."""
    codes = np.concatenate([ids_a + a_size * last_a, 2 * a_size + ids_b + b_size * last_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    return names[codes[order]].tolist()


@dataclass
class Aligned:
    """Alignments of the parts of some lists."""

    counts: np.ndarray  # tokens of A, of B, groups of each part
    groups: list[str]
    link_counts: np.ndarray
    links: np.ndarray
    bad: np.ndarray  # lists whose bytes do not fit; their parts have no tokens


class Aligner:
    """Alignments of blocks of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.a_size, self.b_size = len(self.a.vocabulary.lengths), len(self.b.vocabulary.lengths)
        a, b = [str(i) for i in range(self.a_size)], [str(i) for i in range(self.b_size)]
        written = [i + "," for i in a] + [i + "|" for i in a] + [i + "," for i in b] + [i + ";" for i in b]
        self.names = np.array(written, dtype=object)

    def _side(self, side: Side, texts: list[str], bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, byte ends, tokens of each text, texts that do not fit."""
        tokens = side.encode(texts, bounds, data)
        ends, bad = refined(tokens, side.vocabulary.lengths, bounds)
        keep = ~np.repeat(bad, tokens.counts)
        # Lengths fit: now the bytes themselves.
        ids = tokens.ids[keep]
        fits = np.repeat(~bad, np.diff(bounds))
        laid = side.vocabulary.joined(ids)
        wrong = np.flatnonzero(laid != data[fits])
        if len(wrong):
            at = np.flatnonzero(fits)[wrong]
            bad[np.searchsorted(bounds, at, "right") - 1] = True
        return tokens.ids, ends, tokens.counts, bad

    def align(self, lists: list[list[str]]) -> Aligned:
        """Alignments of parts; the parts of each list are read as one text, which begins with a space."""
        texts = ["".join(parts) for parts in lists]
        sizes = np.array([len(p) if p.isascii() else len(p.encode()) for parts in lists for p in parts], dtype=np.int64)
        part_bounds = np.concatenate([[0], np.cumsum(sizes)])
        bounds = part_bounds[np.cumsum([0, *map(len, lists)])]
        data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
        ids_a, ends_a, counts_a, bad_a = self._side(self.a, texts, bounds, data)
        ids_b, ends_b, counts_b, bad_b = self._side(self.b, texts, bounds, data)
        bad = bad_a | bad_b
        keep_a, keep_b = ~np.repeat(bad, counts_a), ~np.repeat(bad, counts_b)
        ids_a, ends_a, ids_b, ends_b = ids_a[keep_a], ends_a[keep_a], ids_b[keep_b], ends_b[keep_b]
        # Ends rise through the whole block, so all texts are one axis of bytes.
        cuts = np.union1d(ends_a, ends_b)
        links = (ids_a[np.searchsorted(ends_a, cuts)] << _B_BITS) | ids_b[np.searchsorted(ends_b, cuts)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = common[group_a] == ends_a, common[group_b] == ends_b
        written = _texts(ids_a, last_a, ids_b, last_b, group_a, group_b, self.names, self.a_size, self.b_size)
        at_a, at_b, at_group, at_link = (np.searchsorted(x, part_bounds, "right") for x in (ends_a, ends_b, common, cuts))
        at = (at_a + at_b).tolist()
        groups = ["".join(written[i:j])[:-1] for i, j in zip(at, at[1:])]
        counts = np.stack([np.diff(at_a), np.diff(at_b), np.diff(at_group)], axis=1)
        return Aligned(counts, groups, np.diff(at_link), links, bad)


# What surely is no white space, for both libraries.
_SOLID = "[^\\s\u0085\u180e\u200b-\u200d\u2060\ufeff]"
#: Where a text can be cut, each with what no piece of B may contain.
_PLACES = {
    f"(?<! )(?= {_SOLID})": f"[^{_SPACE}]{_SPACE}",
    f"(?<={_SOLID}\n)(?={_SOLID})": "[^\n]\n|\n[^\n]",
    "(?<=[A-Za-z])(?=[,.;:!?])": "[A-Za-z][,.;:!?]",
}


#: What may stand before a part that does not begin with a space: a letter, or a line's end.
_LEADS = (" x", " x\n")


def _lead(part: str) -> list[str]:
    return [] if part[0] == " " else [_LEADS[0] if part[0] in ",.;:!?" else _LEADS[1]]


class Memory:
    """Alignments of the parts that a task has met."""

    #: Parts to remember and their links; beyond, only the most used half is kept.
    MOST = 200_000
    MOST_LINKS = 4_000_000
    #: New parts are read in texts of about so many characters.
    TEXT = 4096

    def __init__(self, path_a: str, path_b: str):
        self.aligner = Aligner(path_a, path_b)
        pieces = [self.aligner.b.model.id_to_piece(i) for i in range(self.aligner.b_size)]
        places = [place for place, crossing in _PLACES.items() if not any(map(re.compile(crossing).search, pieces))]
        self.cut = re.compile("|".join(places) or "(?!)")
        self.joins = re.compile(f" {_SOLID}")
        self._forget()

    def parts_of(self, text: str) -> list[str]:
        """A text, behind a space, as parts that both tokenizers read one by one."""
        parts = self.cut.split(" " + text) if text else []
        return parts if not parts or parts[0] else parts[1:]

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((1 << 16, 3), dtype=np.int32)  # tokens of A, of B, groups
        self.first = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int32)
        self.uses = np.zeros(1 << 16, dtype=np.int64)
        self.links = np.zeros(1 << 18, dtype=np.int64)
        self.used = 0
        led = self.aligner.align([[p] for p in _LEADS])
        self._store(list(_LEADS), led.groups, led.counts, led.link_counts, led.links)

    def _keep_most_used(self, most: int) -> None:
        n = len(self.groups)
        kept = np.sort(np.argsort(-self.uses[:n], kind="stable")[:most])
        kept = kept[kept >= len(_LEADS)]  # these are always there
        lengths = self.length[kept].astype(np.int64)
        after = np.cumsum(lengths)
        links = self.links[np.arange(int(after[-1]) if len(after) else 0) + np.repeat(self.first[kept] - after + lengths, lengths)]
        parts = list(self.number)  # in the order of their numbers
        parts, groups = [parts[i] for i in kept.tolist()], [self.groups[i] for i in kept.tolist()]
        counts, uses = self.counts[kept], self.uses[kept] // 2
        self._forget()
        self._store(parts, groups, counts, lengths, links)
        self.uses[len(_LEADS) : len(_LEADS) + len(parts)] = uses

    def _store(self, parts: list[str], groups: list[str], counts: np.ndarray, lengths: np.ndarray, links: np.ndarray) -> None:
        base, n = len(self.groups), len(parts)
        while len(self.first) < base + n:
            self.counts, self.first, self.length, self.uses = (np.concatenate([v, np.zeros_like(v)]) for v in (self.counts, self.first, self.length, self.uses))
        while len(self.links) < self.used + len(links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.counts[base : base + n] = counts
        self.length[base : base + n] = lengths
        self.first[base : base + n] = self.used + np.cumsum(lengths) - lengths
        self.links[self.used : self.used + len(links)] = links
        self.used += len(links)
        self.groups += groups
        self.number.update(zip(parts, range(base, base + n)))

    def _learn(self, parts: list[str]) -> None:
        """Align new parts and remember them.

        Parts that can stand between spaces are read together, the others alone; so are the
        parts of a text whose bytes do not fit.
        """
        lists: list[list[str]] = []
        sizes = {True: self.TEXT, False: self.TEXT}  # of the last list of ASCII parts, and of others
        last = {True: 0, False: 0}
        for p in parts:
            lead = _lead(p)
            kind = p.isascii()
            if p[-1] == " " or not (lead or self.joins.match(p)):
                lists.append([*lead, p])
            elif sizes[kind] >= self.TEXT:
                last[kind] = len(lists)
                lists.append([*lead, p])
                sizes[kind] = len(p)
            else:
                lists[last[kind]] += [*lead, p]
                sizes[kind] += len(p)
        lists.sort(key=lambda x: not all(map(str.isascii, x)))
        alone: list[list[str]] = []
        begin = 0
        while begin < len(lists):
            end, size = begin, 0
            ascii = all(map(str.isascii, lists[begin]))
            while end < len(lists) and size < BLOCK_BYTES and (end == begin or all(map(str.isascii, lists[end])) == ascii):
                size += sum(map(len, lists[end]))
                end += 1
            alone += self._keep(lists[begin:end])
            begin = end
        for begin in range(0, len(alone), 256):
            self._keep(alone[begin : begin + 256])

    def _keep(self, lists: list[list[str]]) -> list[list[str]]:
        """Remember the parts of some lists; gives those that have to be read alone."""
        found = self.aligner.align(lists)
        parts = list(chain.from_iterable(lists))
        own = np.array([p not in _LEADS for p in parts])
        list_of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        retry = found.bad & (np.bincount(list_of, own, len(lists)) > 1)
        again = [[*_lead(p), p] for p, o, r in zip(parts, own.tolist(), retry[list_of].tolist()) if o and r]
        known = own & ~retry[list_of]
        starts = np.cumsum(found.link_counts) - found.link_counts
        lengths = found.link_counts[known]
        after = np.cumsum(lengths)
        links = found.links[np.arange(int(after[-1]) if len(after) else 0) + np.repeat(starts[known] - after + lengths, lengths)]
        chosen = known.tolist()
        self._store([p for p, k in zip(parts, chosen) if k], [g for g, k in zip(found.groups, chosen) if k], found.counts[known], lengths, links)
        return again

    def align(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """For each text: tokens of A, of B, groups, the groups as text, the links as numbers."""
        split = [self.parts_of(t) for t in texts]
        met = set(chain.from_iterable(split))
        new = met - self.number.keys()
        if len(self.groups) + len(new) > self.MOST or self.used > self.MOST_LINKS:
            # A text whose own links are beyond the bound is still whole: the bound is on what is kept.
            self._keep_most_used(self.MOST // 2 if self.used <= self.MOST_LINKS else 0)
            new = met - self.number.keys()
        self._learn(sorted(new))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        self.uses[: len(self.groups)] += np.bincount(numbers, minlength=len(self.groups))
        lengths = self.length[numbers]
        after = np.cumsum(lengths, dtype=np.int64)
        total = int(after[-1]) if len(after) else 0
        links = self.links[np.arange(total) + np.repeat(self.first[numbers] - after + lengths, lengths)]
        sums = np.concatenate([np.zeros((1, 3), dtype=np.int64), np.cumsum(self.counts[numbers], axis=0)])
        misfits = np.concatenate([[0], np.cumsum(self.counts[numbers, 0] == 0)])  # such parts have no tokens
        edges = np.concatenate([[0], after])
        bounds = np.cumsum([0, *map(len, split)])
        out = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            if a == b or misfits[b] > misfits[a]:
                out.append((0, 0, 0, "", links[:0]))
                continue
            n_a, n_b, n_groups = (sums[b] - sums[a]).tolist()
            groups = ";".join([self.groups[i] for i in numbers[a:b].tolist()])
            out.append((n_a, n_b, n_groups, groups, links[edges[a] : edges[b]]))
        return out


_ALIGNED = "k long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def _align(path_a: str, path_b: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = kept(("alignment", path_a, path_b), lambda: Memory(path_a, path_b))
        for rows in batches:
            for block in blocks(rows.column("text"), BLOCK_BYTES):
                n = len(block)
                found = memory.align([block.raw(i).decode() for i in range(n)])
                here = rows.slice(block.first, n)
                counts = [pa.array([f[j] for f in found], pa.int64()) for j in range(3)]
                n_links = pa.array([len(f[4]) for f in found], pa.int64())
                groups = pa.array([f[3] for f in found], pa.string())
                links = pa.array([f[4].astype("<i8").tobytes() for f in found], pa.binary())
                names = ("k", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links")
                yield batch(dict(zip(names, (here.column("k"), here.column("doc_id"), *counts, n_links, groups, links))))

    return run


def alignments(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """k, doc_id, n_a, n_b, n_groups, n_links, groups, links for every document.

    groups is `a1,a2|b1;a3|b2,b3`: the ids of A and B of each group. links holds one
    64-bit integer for each link in order, A's id * 2^32 + B's id, little-endian.
    """
    docs = keyed(documents).select("k", F.col("doc_id").cast("long"), "text")
    path_a, path_b = path_a or public_file("byte_bpe_50k.json"), path_b or public_file("piece_bpe_32k.model")
    return docs.mapInArrow(_align(path_a, path_b), _ALIGNED)


#: Links that are looked at together, apart from those of one longer document.
LINKS = 1 << 19


def _numbers(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row of some documents, all their links, and the row of each from the first on."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) >> 3
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + LINKS, "right")))
        links = np.frombuffer(b"".join(column.slice(begin, end - begin).to_pylist()), dtype="<i8")
        yield begin, end, links, np.repeat(np.arange(end - begin), sizes[begin:end])
        begin = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for rows in batches:
        for _, _, links, _ in _numbers(rows.column("links")):
            pairs, counts = np.unique(links, return_counts=True)
            yield batch({"pair": longs(pairs), "n": longs(counts.astype(np.int64))})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of that id pair in the corpus), best (no pair of its B id has more)."""
    counts = materialize(aligned.select("links").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND((1 << _B_BITS) - 1)
    # One row for each id of B's vocabulary at most.
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    return counts.join(highest, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _look_up(hot) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over the links whose pair is shipped; the others as one row for each pair of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = hot.value
        for rows in batches:
            keys = rows.column("k").to_numpy()
            for begin, end, links, row in _numbers(rows.column("links")):
                k = keys[begin:end]
                at = np.minimum(np.searchsorted(pairs, links), max(len(pairs) - 1, 0))
                known = pairs[at] == links if len(pairs) else np.zeros(len(links), dtype=bool)
                sums, bests = np.zeros(len(k), dtype=np.int64), np.zeros(len(k), dtype=np.int64)
                np.add.at(sums, row[known], n[at[known]])
                np.add.at(bests, row[known], best[at[known]])
                none = pa.nulls(len(k), pa.int64())
                yield batch({"k": longs(k), "pair": none, "times": none, "count_sum": longs(sums), "n_best": longs(bests)})
                other, owner = links[~known], row[~known]
                order = np.lexsort((other, owner))
                other, owner = other[order], owner[order]
                new = np.append(True, (other[1:] != other[:-1]) | (owner[1:] != owner[:-1]))[: len(other)]
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(other)))
                none = pa.nulls(len(first), pa.int64())
                yield batch({"k": longs(k[owner[first]]), "pair": longs(other[first]), "times": longs(times), "count_sum": none, "n_best": none})

    return run


_LOOKED_UP = "k long, pair long, times long, count_sum long, n_best long"


def scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """k, count_sum, n_best for every document of a written result of `alignments`.

    count_sum adds the corpus count of every link's pair, n_best counts the links whose
    pair is the most frequent of its B id. `counts` is a written result of `pair_counts`.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT > total
    top = counts.filter(is_hot).orderBy("pair").toPandas()
    pairs, n, best = (top[c].to_numpy(dtype=np.int64) for c in ("pair", "n", "best"))
    hot = aligned.sparkSession.sparkContext.broadcast((pairs, n, best))
    seen = materialize(aligned.select("k", "links").mapInArrow(_look_up(hot), _LOOKED_UP))
    rest = seen.filter("pair IS NOT NULL").join(counts.filter(~is_hot), "pair")
    parts = seen.filter("pair IS NULL").select("k", "count_sum", "n_best").unionByName(
        rest.select("k", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"))
    )
    return parts.groupBy("k").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def _digest(groups: Column) -> Column:
    return F.when(groups == "", F.lit("")).otherwise(F.sha2(groups, 256))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    aligned = alignments(documents).withColumn("groups_sha256", _digest(F.col("groups"))).drop("groups")
    with small_batches(documents.sparkSession):
        # Writers hold a row group in memory; the links of one are small ones.
        aligned = materialize(aligned, **{"parquet.block.size": str(16 << 20)})
        scored = scores(aligned, materialize(pair_counts(aligned)))
    scored = scored.withColumnRenamed("k", "scored_k")
    rows = aligned.drop("links").join(scored, F.col("k") == F.col("scored_k"))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
