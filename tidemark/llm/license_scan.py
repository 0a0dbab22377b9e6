"""License and rights statements by ordered signature rules.

A text becomes its words, lower-cased and joined by one space. The rules are expressions over words; the words that every match
of a rule must contain are read off its expression, and a rule is tried only on texts that hold them all. Most texts hold none of
them and cost a look-up per word. Detections of all rules are then ordered by rank, by length, by place and by the order of the
rules; one that lies within another that comes before it is suppressed. Nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_bytes, pieces, schema, whole_rows
from tidemark.llm.decontamination import words_of
from tidemark.llm.license_signatures import BASE, SIGNATURES

CONFIDENCE = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.4}  # of a rank
FOUND = "n_words bigint, found array<struct<rule: int, label: string, first: bigint, last: bigint, base: boolean, kept: boolean, confidence: double>>"


@dataclass(frozen=True)
class Rule:
    rank: int
    label: str
    expression: str
    base: bool = False

    @cached_property
    def compiled(self) -> re.Pattern:
        """Matches with the space in front and before the one behind, so that neighbours can share a space."""
        return re.compile(b" (?:" + self.expression.encode() + b")(?= )")

    @cached_property
    def keywords(self) -> frozenset[bytes]:
        return required_words(self.expression)


def required_words(expression: str) -> frozenset[bytes]:
    """The plain words that stand in an expression outside of all groups, hence in every match."""
    depth, token, tokens = 0, "", []
    for c in expression.replace(" ?", "~"):  # a space that may be missing parts no words
        depth += (c == "(") - (c == ")")
        if c == " " and depth == 0:
            tokens.append(token)
            token = ""
        else:
            token += c
    if depth == 0 and "|" in re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", expression)):
        return frozenset()  # a choice of whole expressions
    plain = [t for i, t in enumerate([*tokens, token]) if re.fullmatch(r"\w+", t)]
    return frozenset(t.encode() for t in plain)


def rules_of(listed: str, base: bool = False) -> list[Rule]:
    """The rules of a list of lines ``rank label: expression``."""
    lines = (re.fullmatch(r"(\d) ([^:,]+): (.+)", line) for line in listed.strip().splitlines())
    return [Rule(int(m[1]), m[2], m[3], base) for m in lines]


RULES = tuple(rules_of(BASE, base=True) + rules_of(SIGNATURES))


class Scanner:
    """Rules by the rarest-looking of their keywords, the longest."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.rules = list(rules)
        self.gates: dict[bytes, list[int]] = defaultdict(list)
        self.always = [i for i, r in enumerate(self.rules) if not r.keywords]
        for i, r in enumerate(self.rules):
            if r.keywords:
                self.gates[max(r.keywords, key=lambda w: (len(w), w))].append(i)

    def candidates(self, words: list[bytes]) -> list[int]:
        """The rules all of whose keywords are among the words."""
        met = self.gates.keys() & set(words)
        if not met:
            return self.always
        every = set(words)
        return sorted(self.always + [i for gate in met for i in self.gates[gate] if self.rules[i].keywords <= every])

    def detections(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(rule, first, last word) of all matches; those of one rule do not overlap, the leftmost goes first."""
        tried = self.candidates(words)
        if not tried or not words:
            return []
        text = b" " + b" ".join(words) + b" "
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])  # of the space in front of every word, and the last one
        out = []
        for i in tried:
            spans = [m.span() for m in self.rules[i].compiled.finditer(text)]
            if spans:
                at = np.searchsorted(starts, np.array(spans))
                out += [(i, a, b - 1) for a, b in at.tolist()]
        return out

    def kept(self, found: list[tuple[int, int, int]]) -> list[bool]:
        """Whether each detection lies within none that comes before it. What lies within a suppressed one also
        lies within that which suppressed it, so that all earlier ones may be asked."""
        order = sorted(range(len(found)), key=lambda d: (self.rules[found[d][0]].rank, found[d][1] - found[d][2], found[d][1], found[d][0]))
        firsts = sorted({first for _, first, _ in found})
        reach = [-1] * (len(firsts) + 1)  # a tree of prefix maxima: how far what begins at or before a place goes
        keep = [False] * len(found)
        for d in order:
            _, first, last = found[d]
            at, far = bisect_right(firsts, first), -1
            i = at
            while i:
                far = max(far, reach[i])
                i &= i - 1
            keep[d] = far < last
            i = at
            while i < len(reach):
                reach[i] = max(reach[i], last)
                i += i & -i
        return keep

    def scan(self, text: bytes | None) -> tuple[int, list[dict]]:
        words = words_of(text)
        found = self.detections(words)
        out = []
        for (i, first, last), kept in zip(found, self.kept(found), strict=True):
            rule = self.rules[i]
            out.append(
                {"rule": i, "label": rule.label, "first": first, "last": last, "base": rule.base, "kept": kept, "confidence": CONFIDENCE[rule.rank]}
            )
        return len(words), out


def scan(docs: DataFrame, rules: Iterable[Rule] = RULES, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, with n_words and all detections: the number and label of the rule, first and
    last word (from 0), whether it is a base phrase, whether it is kept, and its rank's confidence.

    A null or empty text has no words and no detections. Every row gives a row, repeated ones and those of null ids too; other
    columns are carried along. An empty table gives no rows. A text is one row, so one task holds it.
    """
    given = docs.select(whole_rows(docs).alias("doc"), as_bytes(text_column).alias("text"))
    listed = list(rules)
    out = schema(given, FOUND, "doc")
    kinds = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(listed)
        for batch in pieces(batches):
            found = [scanner.scan(text) for text in batch.column(1).to_pylist()]
            sizes, detections = ([f[i] for f in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(detections, kinds.field(2).type)], kinds.names)

    return given.mapInArrow(run, out)
