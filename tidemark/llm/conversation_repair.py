"""Repairing the turn order of conversations by depth-first branch and bound.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Edits are Keep, Rerole, Delete and Insert, each
with a cost; the cheapest list of edits is wanted, and of equally cheap ones that whose initials, the audit, are least in
ASCII. A node of the search is a row and a state of the pattern. An explicit stack holds prefixes; a lower bound of every suffix
and an incumbent (cost, audit) cut branches; a table per node keeps its best prefix and drops worse ones.

Conversations are sorted over all tasks and cut into segments of bounded length, whose searches run wherever the rows lie; a long
conversation is the sum of the searches between the states at its cuts, so that no task searches it as a whole. The sum walks
its segments in order with one digest and one audit for each state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from math import inf

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import schema, staged

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
SEGMENT = 256  # different rows that are searched as one

# States of the pattern: nothing yet, behind s, behind u, behind a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
MADE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}  # what Rerole and Insert give
ENDS = (START, AFTER_A)
LEGAL = {"su", "ua", "au"}
SPACES = "\x20\x09-\x0d"

Path = tuple[int, str]  # cost and audit


@dataclass(frozen=True)
class Row:
    """A row as the search sees it: its role's initial, whether it must go, whether it is truncated, and how
    often it stands there (only rows that must go are counted together)."""

    initial: str
    goes: bool
    truncated: bool
    copies: int = 1


def steps(row: Row | None, state: int) -> Iterator[tuple[int, str, int, int]]:
    """The edits (cost, audit, rows used, next state) that are open in a state at a row, or behind the last."""
    made = NEXT[state, MADE[state][0]]
    yield INSERT_COST, INSERT, 0, made
    if row is None:
        return
    yield DELETE_COST * row.copies, DELETE * row.copies, 1, state
    if not row.goes:
        extra = TRUNCATED_COST * row.truncated
        yield extra + REROLE_COST, REROLE, 1, made
        if (kept := NEXT.get((state, row.initial))) is not None:
            yield extra, KEEP, 1, kept


def lower_bounds(rows: list[Row], exits: tuple[int, ...]) -> list[list[float]]:
    """For every suffix and state, what the suffix costs at least on a way to one of ``exits``, whatever its audit.
    Built from the end, so that a bound costs a step and no search needs to look into a suffix twice."""
    bounds = [[0.0 if s in exits else inf for s in range(4)]]
    for i in range(len(rows), -1, -1):
        row, behind = (rows[i] if i < len(rows) else None), bounds[-1]
        here = list(behind) if row is None else [min(c + behind[to] for c, _, used, to in steps(row, s) if used) for s in range(4)]
        for _ in range(2):  # more than two rows between two others never pay
            here = [min(h, INSERT_COST + here[NEXT[s, MADE[s][0]]]) for s, h in enumerate(here)]
        bounds.append(here)
    return bounds[:0:-1]


def search(rows: list[Row], entry: int, exits: tuple[int, ...]) -> Path | None:
    """The cheapest edits from the state ``entry`` to one of ``exits``, of the least audit; None if there are none."""
    bounds = lower_bounds(rows, exits)
    best: Path | None = None
    reached: dict[tuple[int, int], Path] = {}
    stack = [(bounds[0][entry], "", 0, 0, entry)]
    while stack:
        bound, audit, cost, i, state = stack.pop()
        if bound == inf or best is not None and (bound > best[0] or bound == best[0] and audit > best[1][: len(audit)]):
            continue
        # equal in cost and node, no audit begins another, so that the lesser stays the lesser
        known = reached.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[i, state] = cost, audit
        if i == len(rows) and state in exits and (best is None or (cost, audit) < best):
            best = cost, audit
        row = rows[i] if i < len(rows) else None
        children = [(cost + c + bounds[i + used][to], audit + a, cost + c, i + used, to) for c, a, used, to in steps(row, state)]
        stack += sorted(children, reverse=True)  # the most promising is taken first
    return best


def edited(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """The rows (role, text) after the edits, and the state behind them. The audit tells all: roles that are
    made follow from the state."""
    out, given = [], iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(given)
        if edit == DELETE:
            continue
        role = role if edit == KEEP else MADE[state]
        state = NEXT[state, role[:1]]
        out.append((role, text))
    return out, state


@dataclass
class Walk:
    """The best edits so far that lead to one state, with the digest of what they leave."""

    cost: int
    audit: str
    digest: object
    begun: bool

    def on(self, path: Path, rows: list[tuple[str, str]], state: int) -> Walk:
        digest, begun = self.digest.copy(), self.begun
        for role, text in edited(rows, path[1], state)[0]:
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        return Walk(self.cost + path[0], self.audit + path[1], digest, begun)


@dataclass
class Total:
    """A conversation as far as its segments have come."""

    sums: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0))
    least: int | None = None
    last: int | None = None
    initial: str | None = None
    walks: dict[int, Walk] = field(default_factory=lambda: {START: Walk(0, "", hashlib.sha256(), False)})

    def add(self, part: dict) -> None:
        for name in self.sums:
            self.sums[name] += part[name]
        self.sums["illegal"] += self.initial is not None and self.initial + part["first_initial"] not in LEGAL
        self.initial = part["last_initial"]
        if part["least"] is not None:
            self.sums["turns"] -= part["least"] == self.last
            self.least = part["least"] if self.least is None else self.least
            self.last = part["last"]
        rows = [(r["role"], r["text"]) for r in part["rows"] for _ in range(r["copies"])]
        ways: dict[int, tuple[int, str, int, Path]] = {}
        for p in part["paths"]:
            if (walk := self.walks.get(p["entry"])) is not None:
                way = walk.cost + p["cost"], walk.audit + p["audit"], p["entry"], (p["cost"], p["audit"])
                if p["exit"] not in ways or way[:2] < ways[p["exit"]][:2]:
                    ways[p["exit"]] = way
        self.walks = {to: self.walks[entry].on(path, rows, entry) for to, (_, _, entry, path) in ways.items()}

    def result(self) -> tuple:
        best = min((w for s, w in self.walks.items() if s in ENDS), key=lambda w: (w.cost, w.audit))
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.sums["turns"]
        s = self.sums
        return gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], best.cost, best.audit, best.digest.hexdigest()


PARTS = (
    "place int, number bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least bigint, last bigint, "
    "first_initial string, last_initial string, rows array<struct<role: string, text: string, copies: bigint>>, "
    "paths array<struct<entry: int, exit: int, cost: bigint, audit: string>>"
)
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def faults(rows: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text, copies) with their faults: blank, else repeated, else truncated. Of rows
    alike in conversation, role and text all but the first are duplicates: ``first`` marks the row that holds it.

    A conversation's rows are joined by turn as well as by content, so that a row said at every turn is no hot key."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_column, text_column))
    given = rows.select(F.col(id_column).alias("conv_id"), F.col(turn_column).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    same = F.xxhash64("role", "text").alias("k1"), F.xxhash64("text", F.lit(1), "role").alias("k2")
    every = given.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).select("*", *same)
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = every.groupBy("conv_id", "k1", "k2").agg(F.min(at).alias("at"))
    first = first.select(F.col("conv_id").alias("f_conv"), F.col("k1").alias("f1"), F.col("k2").alias("f2"), F.col("at.turn").alias("f_turn"), F.lit(True).alias("first"))
    here = F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("turn").eqNullSafe(F.col("f_turn"))
    marked = every.join(first, here & (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")), "left")
    blank = ~F.col("text").rlike(f"[^{SPACES}]")
    end = F.regexp_extract("text", f"([^{SPACES}])[{SPACES}]*\\z", 1)
    return marked.select(
        "conv_id", "turn", "role", "text", "copies", blank.alias("blank"), F.coalesce("first", F.lit(False)).alias("first"),
        (~blank & ~end.isin(".", "!", "?")).alias("truncated"),
    )


def _search_rows(rows: list[dict]) -> list[Row]:
    """What the search sees of distinct rows. Copies of a row behind its first are rows that must go."""
    out = []
    for r in rows:
        goes = r["blank"] or not r["first"]
        if goes:
            out.append(Row(r["role"][:1], True, False, r["copies"]))
        else:
            out.append(Row(r["role"][:1], False, r["truncated"]))
            if r["copies"] > 1:
                out.append(Row(r["role"][:1], True, False, r["copies"] - 1))
    return out


def _part(rows: list[dict], whole: bool, begins: bool) -> dict:
    """The counts of a segment and its cheapest edits between all states, or of a whole conversation from start to end."""
    found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    turns, before = [], None
    for r in rows:
        n, role = r["copies"], r["role"][:1]
        if r["blank"]:
            found["blank"] += n
        else:
            found["duplicate"] += n - r["first"]
            found["truncated"] += r["first"] and r["truncated"]
        found["illegal"] += (before is not None and before + role not in LEGAL) + (n - 1) * (role + role not in LEGAL)
        before = role
        if r["turn"] is not None and (not turns or turns[-1] != r["turn"]):
            turns.append(r["turn"])
    seen = _search_rows(rows)
    if whole:
        cost, audit = search(seen, START, ENDS)
        paths = [(START, edited([(r["role"], "") for r in rows for _ in range(r["copies"])], audit, START)[1], cost, audit)]
    else:
        paths = []
        for entry in (START,) if begins else range(4):
            ends = range(entry, 4) if entry < AFTER_U else (AFTER_U, AFTER_A)  # no way leads back
            paths += [(entry, to, *path) for to in ends if (path := search(seen, entry, (to,))) is not None]
    return found | {
        "turns": len(turns), "least": turns[0] if turns else None, "last": turns[-1] if turns else None,
        "first_initial": rows[0]["role"][:1], "last_initial": before,
        "rows": [{k: r[k] for k in ("role", "text", "copies")} for r in rows],
        "paths": [dict(zip(("entry", "exit", "cost", "audit"), p, strict=True)) for p in paths],
    }


def _segments(rows: Iterator[dict], limit: int) -> Iterator[tuple[list[dict], bool, bool]]:
    """Runs of rows of one conversation, whether a run surely is the whole of it, and whether it surely is its start:
    what stands before the first row and behind the last is known to other tasks only."""
    run: list[dict] = []
    begins = False
    for r in rows:
        if run and (r["conv_id"] != run[0]["conv_id"] or len(run) == limit):
            ends = r["conv_id"] != run[0]["conv_id"]
            yield run, begins and ends, begins
            run, begins = [], ends
        run.append(r)
    if run:
        yield run, False, begins


def repair(
    rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one per conversation.

    Rows go by turn, nulls first, ties by role and text. Null roles and texts are one space; an empty role has no initial
    and fits nowhere. Rows with a null id make one conversation. Repeated rows are duplicates of the first. Rows are told
    apart by 128 bits of hashes of role and text. Other columns are not looked at. An empty table gives no rows, and a
    conversation's rows, however many, are searched in segments of at most ``segment`` different ones.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    known = staged(faults(rows, id_column, turn_column, role_column, text_column), "turns")
    ordered = known.repartitionByRange(*order).sortWithinPartitions(*order)
    part_schema, result_schema = schema(ordered, PARTS, "conv_id"), schema(ordered, RESULT, "conv_id")
    part_kinds, result_kinds = to_arrow_schema(part_schema), to_arrow_schema(result_schema)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, size = TaskContext.get().partitionId(), [], 0
        every = (r for batch in batches for r in batch.to_pylist())
        for number, (some, whole, begins) in enumerate(_segments(every, segment)):
            out.append({"conv_id": some[0]["conv_id"], "place": place, "number": number} | _part(some, whole, begins))
            size += sum(len(r["text"]) for r in some)
            if len(out) >= 1000 or size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, part_kinds)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, part_kinds)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (p for batch in batches for p in batch.to_pylist())
        for key, some in groupby(every, lambda p: p["conv_id"]):
            total = Total()
            for part in some:
                total.add(part)
            row = dict(zip(result_kinds.names, (key, *total.result()), strict=True))
            yield pa.RecordBatch.from_pylist([row], result_kinds)

    found = ordered.mapInArrow(parts, part_schema)
    found = found.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place", "number")
    return found.mapInArrow(totals, result_schema)


def damaged(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """The rows (conv_id, turn, role, text) as a test of the repair damages them, by the CRC32 of ``id:turn`` modulo 20: 0 drops
    a row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it a user's. Nulls are one space."""

    def or_space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(or_space(id_column), F.lit(":"), or_space(turn_column)).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(or_space(text_column), "[.!?]", "")).otherwise(or_space(text_column))
    role = F.when(fate == 4, "user").otherwise(or_space(role_column))
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).when(fate == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    given = rows.select(F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    return given.withColumn("copy", F.explode("copies")).drop("copies", "copy")
