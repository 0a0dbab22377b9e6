"""Locally consistent parsing of word sequences by recompression, and the anchors it gives to windows.

A round first names maximal runs of a symbol (symbol, length), then splits the symbols into left and right ones by a
bit of a hash and names every left symbol followed by a right one (symbol, symbol). A name is a hash of
what it stands for, so that it is the same wherever in the corpus it is made. Every symbol carries its extent: the
words that its making depended on. Equal extents make equal symbols, whatever stands around them.
"""

from __future__ import annotations


import numpy as np

ROUNDS = 3
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTES = 4 << 20  # of text whose words are hashed at once


_INSIDE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)], np.int8)  # bytes of words


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OCTETS = mixed(mixed(np.arange(512, dtype=np.uint64) + np.uint64(1))).reshape(2, 256)  # by hash and byte
_POWERS = np.ones((2, 1), np.uint64)  # of the base and of its inverse, grown as needed


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    global _POWERS
    if n > _POWERS.shape[1]:
        size = max(n, 2 * _POWERS.shape[1])
        factors = np.ones((2, size), np.uint64)
        factors[0, 1:], factors[1, 1:] = BASE, INVERSE
        _POWERS = np.cumprod(factors, axis=1, dtype=np.uint64)
    return _POWERS[0, :n], _POWERS[1, :n]


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Two independent 64-bit hashes of every word data[start:stop], from its bytes and length. Words are
    taken in blocks, so that the room needed does not follow the length of a text."""
    out = np.zeros((2, len(start)), np.uint64)
    blocks = np.searchsorted(start, np.arange(0, len(data) + BYTES, BYTES))
    for a, b in zip(blocks, blocks[1:], strict=False):
        if a == b:
            continue
        origin = start[a]
        octets, (power, inverse) = data[origin : stop[b - 1]], powers(stop[b - 1] - origin + 1)
        size = (stop[a:b] - start[a:b]).astype(np.uint64)
        for lane in (0, 1):
            sums = np.zeros(len(octets) + 1, np.uint64)
            np.cumsum(_OCTETS[lane][octets] * power[:-1], out=sums[1:])
            value = (sums[stop[a:b] - origin] - sums[start[a:b] - origin]) * inverse[start[a:b] - origin]
            out[lane, a:b] = mixed(value ^ (size << np.uint64(40)))
    return out


class Prefixes:
    """Hashes of any stretch of a sequence of hashes, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, hashes: np.ndarray) -> None:
        power, self.inverses = powers(len(hashes) + 1)
        self.sums = np.r_[np.uint64(0), np.cumsum(mixed(hashes) * power[:-1], dtype=np.uint64)]

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the words first .. last."""
        value = (self.sums[last + 1] - self.sums[first]) * self.inverses[first]
        return mixed(value ^ (last - first + 1).astype(np.uint64))


def _runs(symbol, low, high, end):
    """Runs named; every symbol has looked at both neighbours."""
    fresh = np.r_[True, (symbol[1:] != symbol[:-1]) | end[1:] | end[:-1]]
    start = np.flatnonzero(fresh)
    length = np.diff(start, append=len(symbol))
    name, is_end = symbol[start], end[start]
    long = length > 1
    name[long] = mixed(name[long] + mixed(length[long].astype(np.uint64)))
    last = start + length - 1
    low = np.where(is_end, low[start], low[np.maximum(start - 1, 0)])
    high = np.where(is_end, high[last], high[np.minimum(last + 1, len(symbol) - 1)])
    return name, low, high, is_end


def _pairs(symbol, low, high, end, salt: int):
    """Left symbols joined with right ones behind them; any other has looked at the side it may pair with."""
    right = (mixed(symbol ^ np.uint64(salt)) >> np.uint64(63)).astype(bool)
    pair = np.r_[~right[:-1] & right[1:] & ~end[:-1] & ~end[1:], False]
    second = np.r_[False, pair[:-1]]
    after, before = np.r_[np.arange(1, len(symbol)), len(symbol) - 1], np.r_[0, np.arange(len(symbol) - 1)]
    name = np.where(pair, mixed(symbol * BASE + mixed(symbol[after])), symbol)
    new_high = np.where(end | (right & ~pair), high, high[after])
    new_low = np.where(end | ~right, low, low[before])
    keep = ~second
    return name[keep], new_low[keep], new_high[keep], end[keep]


def levels(hashes: np.ndarray, end: np.ndarray, rounds: int = ROUNDS) -> list[tuple]:
    """(names, first words, last words of the extents) after 0, 1, .. rounds; ``end`` marks ends of texts."""
    place = np.arange(len(hashes))
    state = hashes.copy(), place, place, end
    out = [state[:3]]
    for r in range(rounds):
        state = _pairs(*_runs(*state), salt=r + 1)
        out.append(state[:3])
    return out


def _least(key: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Index of the smallest key within first .. last, the leftmost of equal ones."""
    table = [np.arange(len(key))]
    width = last - first + 1
    power = np.frexp(width.astype(np.float64))[1] - 1
    for j in range(1, int(power.max(initial=0)) + 1):
        one = table[-1]
        two = one[np.minimum(np.arange(len(key)) + (1 << (j - 1)), len(key) - 1)]
        table.append(np.where(key[one] <= key[two], one, two))
    out = np.empty(len(first), np.int64)
    for j in np.unique(power).tolist():
        some = power == j
        a, b = table[j][first[some]], table[j][last[some] - (1 << j) + 1]
        out[some] = np.where(key[a] <= key[b], a, b)
    return out


def anchors(hashes: np.ndarray, end: np.ndarray, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of neighbouring windows with a common symbol: (name, first window, last window, the symbol's place).

    Of a window, the symbols of the highest level whose extents it contains count, and of these the one of
    smallest hash. As that follows from the window's words alone, equal windows have equal names."""
    behind = np.flatnonzero(end)
    text = np.r_[0, np.cumsum(end)[:-1]]  # which text each word is of
    starts = np.flatnonzero(behind[text] - np.arange(len(hashes)) >= window)
    name, chosen, place = np.zeros(len(starts), np.uint64), np.full(len(starts), -1), np.zeros(len(starts), np.int64)
    for level, (symbol, low, high) in reversed(list(enumerate(levels(hashes, end, rounds)))):
        open_ = np.flatnonzero(chosen < 0)
        if not len(open_):
            break
        first = np.searchsorted(low, starts[open_], side="left")
        last = np.searchsorted(high, starts[open_] + window - 1, side="right") - 1
        has = first <= last
        open_, first, last = open_[has], first[has], last[has]
        order = mixed(symbol ^ np.uint64(0xA5A5 + level))
        best = _least(order, first, last)
        chosen[open_] = best * (rounds + 1) + level
        name[open_], place[open_] = order[best], low[best]
    new = np.r_[True, (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1)] if len(starts) else np.zeros(0, bool)
    group = np.flatnonzero(new)
    last = starts[np.r_[group[1:], len(starts)] - 1] if len(group) else group
    return name[group], starts[group], last, place[group]


def cut(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, the first and the end byte of every word, and the number of words per text."""
    data = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
    edges = np.flatnonzero(np.diff(_INSIDE[data], prepend=np.int8(0)))
    start, stop = edges[::2], edges[1::2]
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    return data, start, stop, np.diff(np.searchsorted(start, np.r_[0, np.cumsum(lengths)]))


def marked(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, where each text ends (a place of its own), and where each begins. An end stands
    before the first text too, so that every word has neighbours."""
    data, start, stop, sizes = cut(texts)
    begin = np.cumsum(sizes + 1) - sizes
    end = np.zeros(len(start) + len(texts) + 1, bool)
    end[begin + sizes] = end[0] = True
    out = np.zeros((2, len(end)), np.uint64)
    out[:, ~end] = word_hashes(data, start, stop)
    return out, end, begin
