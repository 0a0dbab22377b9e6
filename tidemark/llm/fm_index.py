"""An FM-index over integers: suffix order, wavelet matrix over the BWT, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16  # every so many positions the suffix position is kept


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order. Zeros end records: they are smaller than all other symbols
    and ordered by position, so that no comparison passes one. The last symbol must be a zero.

    Ranks by the first symbols are refined by the ranks one and two lengths on, which triples the length
    compared; only suffixes that still tie are sorted again."""
    n = len(symbols)
    if n >= 1 << 21:
        raise ValueError("too long for one index")
    zero = symbols == 0
    first = np.where(zero, np.cumsum(zero) - 1, symbols + int(zero.sum()))
    _, rank = np.unique(first, return_inverse=True)
    rank = np.r_[rank, 0, 0].astype(np.int64)
    slots, order = np.arange(n), np.arange(n)
    result, length, tied = np.empty(n, np.int64), 1, order
    while len(tied):
        key = rank[tied] << 42 | rank[np.minimum(tied + length, n)] << 21 | rank[np.minimum(tied + 2 * length, n)]
        by = np.argsort(key, kind="stable")
        key, tied = key[by], tied[by]
        result[slots] = tied
        fresh = np.r_[True, key[1:] != key[:-1]]
        starts = np.flatnonzero(fresh)
        rank[tied] = np.repeat(slots[starts], np.diff(starts, append=len(tied)))
        again = ~(fresh & np.r_[fresh[1:], True])
        slots, tied, length = slots[again], tied[again], length * 3
    return result


class Wavelet:
    """Ranks in a sequence over 0 .. size-1."""

    def __init__(self, sequence: np.ndarray, size: int) -> None:
        self.levels = []
        for bit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1
            zeros = np.r_[0, np.cumsum(1 - ones, dtype=np.int32)].astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            sequence = np.concatenate([sequence[ones == 0], sequence[ones == 1]])
        self.origin = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, zeros, total in self.levels:
            before = zeros[at].astype(np.int64)
            at = np.where((symbols >> bit) & 1, total + at - before, before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._down(symbols, at) - self.origin[symbols]


class FMIndex:
    """Search in a sequence of integers 0 .. size-1 that ends with 0, where zeros separate records."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        order = suffix_order(symbols)
        self.n = len(symbols)
        self.last = symbols[order - 1]  # the symbol before each suffix; the first position follows the final zero
        self.below = np.r_[0, np.cumsum(np.bincount(symbols, minlength=size))]
        self.wavelet = Wavelet(self.last, size)
        kept = (order % SAMPLE == 0) | (self.last == 0)  # walks back need not pass the end of a record
        self.number = np.cumsum(kept) - 1
        self.kept, self.position = kept, order[kept]

    def _step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbols] + self.wavelet.rank(symbols, at)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For phrases that occur (rows of one length, no zeros): their numbers and suffix ranges [lo, hi)."""
        which = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[which, column]
            lo, hi = self._step(symbols, lo), self._step(symbols, hi)
            alive = lo < hi
            which, lo, hi = which[alive], lo[alive], hi[alive]
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to the nearest kept one."""
        found, todo, walked = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            here = self.kept[rows]
            found[todo[here]] = self.position[self.number[rows[here]]] + walked
            rows, todo = rows[~here], todo[~here]
            rows = self._step(self.last[rows], rows)
            walked += 1
        return found
