"""Formatting conversations with a template that is only called, never looked into.

The template is a function from a list of (role, text) to a string. The prefixes of a conversation are rendered one
after the other; where a render only extends the one before, the extension is the span of the turn, and
where it does not, the template rewrites history. What stands around a text within its span is learned
by rendering the same turn with two probes for its text, which differ in one character.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import schema

Template = Callable[[list[tuple[str, str]]], str]

OPEN, SEPARATOR, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = {"\\": "\\b", "###": "\\h", "</turn>": "\\e"}
UNESCAPES = {v: k for k, v in ESCAPES.items()} | {"\\c": ":"}
CONTEXT = 4  # turns
PROBES = "\ue000", "\ue001"  # private-use characters, as texts of two probe renders

_ESCAPED = re.compile("|".join(map(re.escape, ESCAPES)))
_UNESCAPED = re.compile("|".join(map(re.escape, UNESCAPES)))
_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(CLOSE), re.DOTALL)

TURNS = "array<struct<role: string, first: bigint, last: bigint, text_first: bigint, text_last: bigint>>"
OUTPUT = f"formatted string, turns {TURNS}, rewrites_history boolean, rewritten_at bigint"


def escape(text: str) -> str:
    """The text without control strings. Reversible, as the escape character is escaped first."""
    return _ESCAPED.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(lambda m: UNESCAPES[m[0]], text)


class PerTurn:
    """A template that renders each turn by itself, by a function of its role and text, one after the other. It keeps the last
    list that grew turn by turn and what it gave, so that the next longer list costs its last turn and a copy of the text."""

    def __init__(self, turn: Callable[[str, str], str]) -> None:
        self.turn = turn
        self.turns: list[tuple[str, str]] = []
        self.before = self.text = ""  # without the last turn, and with it

    def __call__(self, turns: list[tuple[str, str]]) -> str:
        if turns and turns[:-1] == self.turns:
            self.turns, self.before, self.text = list(turns), self.text, self.text + self.turn(*turns[-1])
        elif turns and turns[:-1] == self.turns[:-1]:
            return self.before + self.turn(*turns[-1])
        else:
            parts = [self.turn(role, text) for role, text in turns]
            self.turns, self.before, self.text = list(turns), "".join(parts[:-1]), "".join(parts)
        return self.text


def _marked(role: str, text: str) -> str:
    return f"{OPEN}{_shown(role)}{SEPARATOR}{escape(text)}{CLOSE}"


marked_turns = PerTurn(_marked)  # the default template: ``### Role: text </turn>`` on a line of its own for every turn


def _shown(role: str) -> str:
    """A plain role capitalised, any other behind a backslash as it is; without the separator's colon."""
    plain = re.fullmatch("[a-z]+", role)
    return escape(role.capitalize() if plain else "\\" + role).replace(":", "\\c")


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn in the output of the default template."""
    found = []
    for role, text in _TURN.findall(formatted):
        role = unescape(role)
        found.append((role[1:] if role[:1] == "\\" else role.lower(), unescape(text)))
    return found


def _agree(a: str, b: str) -> int:
    """Length of the common start, by halving the part in which they first differ."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def _turn(turns: list[tuple[str, str]], template: Template, before: str) -> tuple[str, int, int | None, int | None]:
    """The render of all turns, the length it has in common with the one before, and where the last text is."""
    now = template(turns)
    first = len(before) if now.startswith(before) else _agree(before, now)
    one, two = (template([*turns[:-1], (turns[-1][0], p)]) for p in PROBES)
    same = len(before) if one.startswith(before) and two.startswith(before) else 0
    at = same + _agree(one[same:], two[same:])  # the probes differ in their only character
    behind = one[at + 1 :]
    told = one[at : at + 1] == PROBES[0] and two[at : at + 1] == PROBES[1] and two[at + 1 :] == behind
    told = told and first >= same and one[same:at] == now[same:at]
    if told and now.endswith(behind) and len(now) - len(behind) >= at:
        return now, first, at, len(now) - len(behind)
    return now, first, None, None


def _span(role: str, first: int, last: int, text_first: int | None, text_last: int | None) -> dict:
    return {"role": role, "first": first, "last": last, "text_first": text_first, "text_last": text_last}


def _by_prefixes(turns: list[tuple[str, str]], template: Template) -> tuple[str, list[dict], int | None]:
    spans, before, changed = [], template([]), None
    for i, (role, _) in enumerate(turns):
        now, first, *text = _turn(turns[: i + 1], template, before)
        if first < len(before):
            changed = first if changed is None else min(changed, first)
        spans.append(_span(role, first, len(now), *text))
        before = now
    if changed is not None:  # spans that lie behind a change no longer hold
        spans[:-1] = [s if s["last"] <= changed else s | {"text_first": None, "text_last": None} for s in spans[:-1]]
    return before, spans, changed


def _by_context(turns: list[tuple[str, str]], template: Template, context: int = CONTEXT) -> tuple[str, list[dict], int | None] | None:
    """As by prefixes, but every turn is rendered behind ``context`` others only. What this gives is compared with
    the render of whole prefixes of doubling length; where they differ, there is no result."""
    spans, grown, at, check = [], [template([])], len(template([])), 1
    for i, (role, _) in enumerate(turns):
        near = turns[max(0, i - context) : i + 1]
        before = template(near[:-1])
        now, first, *text = _turn(near, template, before)
        if first < len(before):
            return None
        shift = at - len(before)
        spans.append(_span(role, at, shift + len(now), *(t if t is None else t + shift for t in text)))
        grown.append(now[len(before) :])
        at = shift + len(now)
        if i + 1 in (check, len(turns)):
            whole, check = "".join(grown), 2 * check
            if whole != template(turns[: i + 1]):
                return None
            grown = [whole]
    return grown[0], spans, None


def render(turns: list[tuple[str, str]], template: Template, context: int | None = None) -> tuple[str, list[dict], int | None]:
    """The formatted conversation, the span of every turn and of its text, and the first place at which a
    later turn changed what had been rendered, if any. A text whose place cannot be told has no span.

    Every prefix is rendered and compared with the one before, whatever the template and the number of turns, as any turn may
    rewrite what stands before it: texts of the square of the turns are made and compared. With ``context``, turns are
    rendered behind so many others only, where this adds up to the render of prefixes of doubling length."""
    return context is not None and _by_context(turns, template, context) or _by_prefixes(turns, template)


def format_conversations(rows: DataFrame, template: Template = marked_turns, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """Rows (conv_id, formatted, turns, rewrites_history, rewritten_at), one per conversation.

    Turns go by turn number, nulls first, ties by role and text; repeated rows are repeated turns. Null roles
    and texts are empty. Rows with a null conversation id make one conversation. Spans count code points,
    ends excluded. Other columns are not looked at; an empty table gives no rows. A conversation is one
    text, so that one task holds it, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                turns = [(t["role"] or "", t["text"] or "") for t in batch.column(1)[i].as_py()]
                text, spans, changed = render(turns, template)
                columns = [
                    batch.column(0).slice(i, 1),
                    pa.array([text], pa.string()),
                    pa.array([spans], turn_type),
                    pa.array([changed is not None]),
                    pa.array([changed], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "turns", "rewrites_history", "rewritten_at"])

    turn_type = pa.list_(pa.struct([("role", pa.string()), *((k, pa.int64()) for k in ("first", "last", "text_first", "text_last"))]))
    turn = F.struct(F.col(turn_column).alias("turn"), F.col(role_column).alias("role"), F.col(text_column).alias("text"))
    grouped = rows.groupBy(F.col(id_column).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.mapInArrow(run, schema(grouped, OUTPUT, "conv_id"))


def loss_text(formatted: str, turns: list[dict], role: str = "assistant") -> str:
    """The texts under the loss mask, unescaped: those of the role's turns, one after the other."""
    return "".join(unescape(formatted[t["text_first"] : t["text_last"]]) for t in turns if t["role"] == role and t["text_first"] is not None)
