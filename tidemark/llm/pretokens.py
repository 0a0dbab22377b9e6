"""Cutting texts into the pieces that a byte-level BPE encodes one by one, with memory of pieces seen before.

A space between two characters that are no white space always starts a new match of the pattern, so a
text without two neighbouring white-space characters is the sequence of its space-separated chunks, each
with its space in front. Chunks repeat far more often than they are new; what is known of a chunk is kept.
Any other text goes through the pattern as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import regex

_GAP = re.compile(r"\s\s")


ENTRY = 200  # bytes that an entry takes beside its text and value


class Recent:
    """Memory of bounded size: at ``limit`` bytes the older generation is forgotten. What is forgotten
    is worked out again, so that no result depends on it. Texts of over a hundredth of the limit are forgotten at once."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}
        self.size, self.passing = 0, []

    def recall(self, keys: Iterable) -> list:
        """Those of the keys that are not known; the others are in ``new`` afterwards."""
        found, before = [], len(self.new)
        for key in keys:
            if (value := self.old.get(key)) is None:
                found.append(key)
            else:
                self.new[key] = value
        self.size += (len(self.new) - before) * (ENTRY + 20)  # of which most are short
        return found

    def learn(self, keys: list, values: Iterable) -> None:
        self.new.update(zip(keys, values, strict=True))
        sizes = list(map(len, keys))
        self.size += ENTRY * len(sizes) + 2 * sum(sizes)  # a value is about as long as its text
        if max(sizes, default=0) > self.limit // 200:
            passing = [k for k, n in zip(keys, sizes, strict=True) if n > self.limit // 200]
            self.passing += passing
            self.size -= sum(ENTRY + 2 * len(k) for k in passing)

    def age(self) -> None:
        for key in self.passing:
            self.new.pop(key, None)
        self.passing = []
        if self.size >= self.limit:
            self.old, self.new, self.size = self.new, {}, 0


class Cutter:
    """Texts as sequences of values of their chunks.

    ``solve`` gets a list of distinct pre-tokens and returns a value for each; ``join`` makes one value of
    the values of a chunk's pre-tokens. Values are true."""

    def __init__(self, pattern: str, solve: Callable, join: Callable, cache: int = 80 << 20) -> None:
        self.pattern = regex.compile(pattern)
        self.solve, self.join = solve, join
        # two generations of each; a third for chunks
        self.chunks, self.words = Recent(cache // 6), Recent(cache // 3)

    def _cut(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk behind a space. Letters alone, or with one mark behind, need no pattern."""
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
        return self.pattern.findall(" " + chunk)

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its parts, in order."""
        self.chunks.age()
        self.words.age()
        get, parts, heads, fresh = self.chunks.new.get, [], [], set()
        for text in texts:
            if _GAP.search(text):
                head, chunks = self.pattern.findall(text), []
            else:
                first, *chunks = text.split(" ")
                head = self.pattern.findall(first)
                if chunks and not chunks[-1]:  # the text ends with a space
                    chunks.pop()
                    head, chunks = self.pattern.findall(text), []
            known = list(map(get, chunks))
            if not all(known):
                fresh.update(c for c, v in zip(chunks, known, strict=True) if v is None)
                known = None
            parts.append((chunks, known))
            heads.append(head)
        fresh = self.chunks.recall(fresh)
        words = list(map(self._cut, fresh))
        need = {w for some in (words, heads) for ws in some for w in ws}
        new = self.words.recall(need.difference(self.words.new))
        self.words.learn(new, self.solve(new))
        value, join = self.words.new.__getitem__, self.join
        self.chunks.learn(fresh, (join(map(value, ws)) for ws in words))
        take = self.chunks.new.__getitem__
        return [
            list(map(value, head)) + (list(map(take, chunks)) if known is None else known)
            for head, (chunks, known) in zip(heads, parts, strict=True)
        ]
