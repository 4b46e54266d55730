"""Vectorised hashing of words, shingles and windows over Arrow text columns.

Everything here works on one block of texts at a time: a few megabytes, cut at row
boundaries, so a task's memory is bounded by the block or by its longest text.
All hashes are 64-bit polynomials modulo 2^64 over random symbols, passed through a
finaliser; equal input gives equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
#: White space that separates words: space and U+0009 to U+000D.
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser of 64-bit values; the seed gives another function."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(256, dtype=np.uint64), 7)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
#: For a second hash that shares nothing with the first: other symbol values under another base.
SECOND_BASE = 0xA3B195354A39B70D
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept, and grown when a longer block comes."""
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors)
    return _powers[base][:n]


class Rolling:
    """Hashes of any ranges of one sequence of 64-bit symbols, from one running sum."""

    def __init__(self, symbols: np.ndarray, base: int = _BASE):
        n = len(symbols)
        self.inverse = _INVERSE if base == _BASE else pow(base, -1, 2**64)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * _power(base, n), out=self.total[1:])

    @classmethod
    def second(cls, symbols: np.ndarray) -> Rolling:
        return cls(mix(symbols, 77), SECOND_BASE)

    def ranges(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        back = _power(self.inverse, len(self.total))
        value = (self.total[ends] - self.total[starts]) * back[starts]
        return mix(value + (ends - starts).astype(np.uint64), seed)

    def windows(self, size: int, seed: int = 0) -> np.ndarray:
        """The hash of each run of `size` symbols, by its start."""
        n = len(self.total) - size
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        value = (self.total[size:] - self.total[:n]) * _power(self.inverse, len(self.total))[:n]
        return mix(value, seed)


@dataclass
class Block:
    """Some consecutive texts: their bytes, and where each text begins and ends in them."""

    first: int  # the row of the first text in its batch
    data: np.ndarray
    bounds: np.ndarray  # len(texts) + 1 byte positions

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, row: int) -> bytes:
        return self.data[self.bounds[row] : self.bounds[row + 1]].tobytes()


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks of about `most` bytes; a null text counts as empty."""
    column = pc.cast(column, pa.large_string())
    column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    octets = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        end = min(end, n)
        yield Block(row, octets[at[row] : at[end]], at[row : end + 1] - at[row])
        row = end


@dataclass
class Words:
    """The words of a block: byte ranges, hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # len(texts) + 1 word positions
    hashes: np.ndarray


def words_of(block: Block, lower: bool) -> Words:
    """Maximal runs of bytes other than the separators; `lower` folds A-Z only."""
    data = _LOWER[block.data] if lower else block.data
    apart = _SEPARATOR[data]
    before = np.ones(len(data), dtype=bool)
    before[1:] = apart[:-1]
    inside = block.bounds[:-1]
    before[inside[inside < len(data)]] = True
    after = np.ones(len(data), dtype=bool)
    after[:-1] = apart[1:]
    ends = block.bounds[1:] - 1
    after[ends[ends >= 0]] = True
    starts = np.flatnonzero(~apart & before)
    stops = np.flatnonzero(~apart & after) + 1
    hashes = Rolling(_BYTE_VALUE[data]).ranges(starts, stops)
    return Words(starts, stops, np.searchsorted(starts, block.bounds), hashes)


def byte_symbols(block: Block) -> np.ndarray:
    return _BYTE_VALUE[block.data]


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and their bounds by text.

    A text with fewer words, but one at least, has a single shingle: all its words.
    """
    n = np.diff(words.bounds)
    rolling = Rolling(words.hashes)
    per = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    text = np.repeat(np.arange(len(n)), per)
    starts = words.bounds[:-1][text] + np.arange(bounds[-1]) - bounds[:-1][text]
    ends = np.minimum(starts + size, words.bounds[1:][text])
    return rolling.ranges(starts, ends, 3), bounds


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost least value of each run of `width` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    bits = np.uint64(max(1, int(len(values)).bit_length()))
    key = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:n], key[width - span : width - span + n])
    return (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
