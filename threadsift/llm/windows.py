"""Super-k-mers: runs of consecutive windows of a text that share one minimiser.

A window is `size` consecutive symbols (words or bytes) of one text. Its minimiser is
the run of `core` symbols in it with the least hash, the leftmost of equals, so equal
windows have equal minimisers wherever they stand. Consecutive windows whose minimiser
is the same run of the text form one super-k-mer; all windows that can be equal meet
under the hash of their minimiser.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from threadsift.llm.hashing import Rolling, sliding_least


@dataclass
class Runs:
    """Super-k-mers of a block, in order of text and start."""

    row: np.ndarray  # text in the block
    start: np.ndarray  # first window, in symbols of its text
    count: np.ndarray  # windows
    key: np.ndarray  # hash of the minimiser
    at: np.ndarray  # first window, in symbols of the block


def super_kmers(symbols: np.ndarray, bounds: np.ndarray, size: int, core: int) -> Runs:
    """symbols: 64-bit values; bounds: len(texts) + 1 positions of the texts in them."""
    lengths = np.diff(bounds)
    n = len(symbols) - size + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return Runs(none, none, none, none.astype(np.uint64), none)
    cores = Rolling(symbols).windows(core, 11)
    least = sliding_least(cores, size - core + 1)
    # Texts hold lengths - size + 1 windows; those across a border belong to none.
    text = np.repeat(np.arange(len(lengths)), lengths)[:n]
    whole = np.arange(n) + size <= bounds[1:][text]
    new = whole.copy()
    new[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new)
    window_no = np.cumsum(whole)
    total = int(window_no[-1])
    ranks = window_no[first] - 1
    count = np.diff(np.concatenate([ranks, [total]]))
    row = text[first]
    return Runs(row, first - bounds[:-1][row], count, cores[least[first]], first)
