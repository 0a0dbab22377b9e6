"""Byte-level BPE as relations: an in-process SQL engine in every task contracts token rows.

A word is a chain of token rows. One step of the recursive query joins
the rows with the merge table, takes each word's pair of lowest rank, leftmost first, and contracts it.
Words without a pair leave the recursion. Long words are encoded in overlapping windows, which are words like any other. Where two
windows agree on an end of a token, their tokens are joined if the two that meet there are what their bytes together
encode to: a sequence whose neighbours all pass this is the encoding of the whole. Where no such place is found, a step of
its own contracts the long word at once: all occurrences of the lowest pair up to the first whose contraction opens a lower one.
Decoding joins the ids with the vocabulary and concatenates in order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import hold, pieces, schema
from tidemark.llm.pretokens import Cutter

LONG = 200  # bytes; longer words are encoded in windows
WINDOWS = 48, 192  # bytes of a window, which overlaps with the next by half; the longer are tried where the shorter fail
PIECE = 1 << 20  # bytes of text that are cut and encoded at once
WORDS = 15_000  # words per recursive query, and their bytes, which bound its rows
LETTERS = 200_000
TOKENS = 300_000  # token rows per decoding query, unless one text has more

# A row is a token: g is the word's number and the start (8 bits), e the end, nx the next token. A pair's rank,
# start and end make one number, whose minimum is the leftmost pair of lowest rank.
SHORT_WORDS = """
with recursive chain as (
    select g, e, t, nx, false as done from letters
    union all (
    with paired as materialized (
        select c.g, c.e, c.t, c.nx, (m.rank::bigint << 16) + ((c.g & 255) << 8) + c.e as pair
        from chain c left join merges m on m.pair = (c.t::bigint << 20) | c.nx where not c.done),
    lowest as (select g >> 8 as w, min(pair) as best from paired group by g >> 8),
    chosen as (
        select l.w, (l.best >> 16)::int as made, ((l.best >> 8) & 255)::int as at, (l.best & 255)::int as q, r.e, r.nx
        from lowest l left join paired r on r.g = (l.w << 8) + (l.best & 255)::int)
    select r.g, case when (r.g & 255) = c.at then c.e else r.e end,
        case when (r.g & 255) = c.at then c.made else r.t end,
        case when (r.g & 255) = c.at then c.nx when r.e = c.at then c.made else r.nx end, c.made is null
    from paired r join chosen c on (r.g >> 8) = c.w where c.q is null or (r.g & 255) <> c.q))
select g >> 8 as w, t from chain where done order by g"""

LONG_WORDS = """
with recursive chain as (
    select w, p, t, false as done from letters
    union all (
    with numbered as (
        select w, p, t, lead(t) over follow as nx, lead(t, 2) over follow as nx2, lag(t) over follow as pv, row_number() over follow as i
        from chain where not done window follow as (partition by w order by p)),
    paired as (
        select n.*, m.rank, min(m.rank) over (partition by n.w) as low
        from numbered n left join merges m on m.pair = (n.t::bigint << 20) | n.nx),
    runs as (
        select *, coalesce(rank = low, false) as cand, i - row_number() over (partition by w, coalesce(rank = low, false) order by p) as run
        from paired),
    leftmost as (
        select *, cand and (row_number() over (partition by w, cand, run order by p)) % 2 = 1 as hit from runs),
    opened as (
        select l.*, hit and coalesce(least(a.rank, b.rank) < low, false) as lower
        from (select *, case when lag(hit, 2) over (partition by w order by p) then low else pv end as pv2 from leftmost) l
        left join merges a on a.pair = (l.pv2::bigint << 20) | l.low
        left join merges b on b.pair = (l.low::bigint << 20) | l.nx2),
    cut as (
        select *, hit and coalesce(sum(lower::int) over (partition by w order by p rows between unbounded preceding and 1 preceding), 0) = 0 as done_now
        from opened)
    select w, p, t, done from (
        select w, p, case when done_now then low else t end as t, low is null as done,
            coalesce(lag(done_now) over (partition by w order by p), false) as gone
        from cut) where not gone))
select w, p, t from chain where done order by p"""

DECODE = """
select d, array_to_string(list(v.text order by p), '') from tokens join vocabulary v using (t) group by d"""


class Ranks:
    """A rank file: byte strings and their ids, and the pairs of ids that make another."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.ids = {base64.b64decode(s): int(i) for s, i in (line.split() for line in file if line.strip())}
        if max(self.ids.values(), default=0) >= 1 << 20:
            raise ValueError("more ids than a pair key has room for")
        pairs = [(a, b, i) for s, i in self.ids.items() for k in range(1, len(s)) if (a := self.ids.get(s[:k])) is not None and (b := self.ids.get(s[k:])) is not None]
        self.pairs = np.array(pairs, np.int64).reshape(-1, 3)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)


class Engine:
    """The SQL engine of one Python task."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.known = np.zeros(max(ranks.ids.values(), default=0) + 1, bool)
        self.known[list(ranks.ids.values())] = True
        self.texts = {i: t for t, i in ranks.ids.items()}
        self.sizes = np.zeros(len(self.known), np.int64)
        self.sizes[list(self.texts)] = list(map(len, self.texts.values()))
        left, right, made = ranks.pairs.T
        self.fill("merges", pair=(left << 20) | right, rank=made.astype(np.int32))
        self.fill("vocabulary", t=np.array(list(ranks.ids.values()), np.int32), text=[s.decode("latin-1") for s in ranks.ids])

    def fill(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from given")
        self.db.unregister("given")

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of every word, as little-endian 32-bit integers."""
        raw = [w.encode() for w in words]
        out = [self.ranks.ids.get(w) for w in raw]
        out = [None if i is None else i.to_bytes(4, "little") for i in out]
        todo = [i for i, x in enumerate(out) if x is None]
        short = [i for i in todo if len(raw[i]) <= LONG]
        for i, ids in zip(short, self._short([raw[i] for i in short]), strict=True):
            out[i] = ids
        for i in todo:
            if len(raw[i]) > LONG:
                found = (self._windows(raw[i], size) for size in WINDOWS)
                out[i] = next(filter(None, found), None) or self._contract(LONG_WORDS, [raw[i]])[0]
        return out

    def _short(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of at most LONG bytes; so many at once that the rows stay bounded. Words alike are solved once."""
        if len(distinct := list(dict.fromkeys(words))) < len(words):
            known = dict(zip(distinct, self._short(distinct), strict=True))
            return [known[w] for w in words]
        out, start, size = [], 0, 0
        for i, w in enumerate(words):
            size += len(w)
            if i - start == WORDS or size > LETTERS:
                out += self._contract(SHORT_WORDS, words[start:i])
                start, size = i, len(w)
        return out + (self._contract(SHORT_WORDS, words[start:]) if start < len(words) else [])

    def _windows(self, word: bytes, window: int) -> bytes | None:
        """The ids of a long word from those of its windows; None if two neighbours cannot be joined."""
        stride = window // 2
        starts = range(0, len(word) - window + stride, stride)
        out, behind = [], None  # a piece of the word at a time: its windows, and the last one of the piece before
        for first in range(0, len(starts), PIECE // stride):
            some = starts[first : first + PIECE // stride]
            ids = [np.frombuffer(x, "<i4") for x in self._short([word[a : a + window] for a in some])]
            ends = [a + np.cumsum(self.sizes[x]) for a, x in zip(some, ids, strict=True)]
            if behind is not None:
                ids, ends = [behind[0], *ids], [behind[1], *ends]
            places = self._joints(ids, ends)
            if places is None:
                return None
            begin = 0 if behind is None else behind[2]
            for k, (i, j) in enumerate(places):
                out.append(ids[k][begin : i + 1])
                begin = j
            behind = ids[-1], ends[-1], begin
        out.append(behind[0][behind[2] :])
        return np.concatenate(out).astype("<i4").tobytes()

    def _joints(self, ids: list[np.ndarray], ends: list[np.ndarray]) -> list[tuple[int, int]] | None:
        """For every two neighbouring windows, the last token of the one and the first of the other."""
        options = []
        for x, y in zip(ends, ends[1:], strict=False):
            shared, i, j = np.intersect1d(x[:-1], y[:-1], return_indices=True)
            order = np.argsort(np.abs(shared - (x[-1] + y[0]) / 2))  # away from the edges of the windows
            options.append([(int(i[k]), int(j[k]) + 1) for k in order])
        chosen: list = [None] * len(options)
        for attempt in range(max(map(len, options), default=0)):
            open_ = [k for k, c in enumerate(chosen) if c is None and attempt < len(options[k])]
            if not open_:
                break
            pairs = [(ids[k][options[k][attempt][0]], ids[k + 1][options[k][attempt][1]]) for k in open_]
            texts = [self.texts[a] + self.texts[b] for a, b in pairs]
            fits = [len(t) <= LONG for t in texts]
            found = iter(self._short([t for t, f in zip(texts, fits, strict=True) if f]))
            for k, pair, f in zip(open_, pairs, fits, strict=True):
                if f and next(found) == np.array(pair, "<i4").tobytes():
                    chosen[k] = options[k][attempt]
        return None if any(c is None for c in chosen) else chosen

    def _contract(self, step: str, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = self.ranks.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        if step is SHORT_WORDS:
            start = (np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            following = np.r_[letters[1:], np.int32(-1)]
            following[np.cumsum(sizes) - 1] = -1
            rows = {"g": owner << 8 | start, "e": start + 1, "t": letters, "nx": following}
        else:
            rows = {"w": owner, "p": np.arange(len(letters)), "t": letters}
        self.db.register("letters", pa.table(rows))
        rows = self.db.execute(step).fetchnumpy()
        self.db.unregister("letters")
        ends = 4 * np.cumsum(np.bincount(rows["w"], minlength=len(words)))
        data = rows["t"].astype("<i4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The bytes of texts of so many ids each, whose ids stand one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        ends, out, first = np.cumsum(sizes), [], 0
        while first < len(sizes):
            begin = int(ends[first] - sizes[first])
            last = max(first + 1, int(np.searchsorted(ends, begin + TOKENS, side="right")))
            end = int(ends[last - 1])
            owners = np.repeat(np.arange(last - first, dtype=np.int32), sizes[first:last])
            self.db.register("tokens", pa.table({"d": owners, "p": np.arange(end - begin, dtype=np.int32), "t": ids[begin:end]}))
            found = dict(self.db.execute(DECODE).fetchall())
            self.db.unregister("tokens")
            out += [found.get(i, "").encode("latin-1") for i in range(last - first)]
            first = last
        return out


CACHE_BYTES = 80 << 20  # of known chunks and words that a worker keeps by default

_ENGINES: dict[str, Engine] = {}  # of this Python worker, for the last vocabulary
_CUTTERS: dict[tuple, Cutter] = {}


def _release() -> None:
    _ENGINES.clear()
    _CUTTERS.clear()


def _engine(shared: Broadcast, path: str) -> Engine:
    if path not in _ENGINES:
        _release()
        _ENGINES[path] = Engine(shared.value)
        hold("byte_bpe", _release)
    return _ENGINES[path]


def _cutter(shared: Broadcast, path: str, pattern: str, cache: int = CACHE_BYTES) -> Cutter:
    engine = _engine(shared, path)
    if (path, pattern, cache) not in _CUTTERS:
        _CUTTERS.clear()
        _CUTTERS[path, pattern, cache] = Cutter(pattern, engine.encode, b"".join, cache)
    return _CUTTERS[path, pattern, cache]


def _encoded(cutter: Cutter, texts: pa.Array) -> list[bytes]:
    return [b"".join(v) for v in cutter.values([t or "" for t in texts.to_pylist()])]


def _shared(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(Ranks(path))  # as large as the vocabulary


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, token_ids array<int>): every text by the ranks of the file, without special tokens.

    Null and empty texts have no ids. Repeated rows and ids give a row each, null ids are kept, and other
    columns are not looked at. An empty table gives no rows.
    """
    shared = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(shared, path, pattern)
        for batch in pieces(batches, limit=PIECE, holder="byte_bpe"):
            encoded = _encoded(cutter, batch.column(1))
            offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(encoded), "<i4"))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "token_ids"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema(chosen, "token_ids array<int>"))


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """Rows (doc_id, decoded binary): the bytes that the ids stand for. Null and empty lists give no bytes;
    an id outside the vocabulary raises."""
    shared = _shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = _engine(shared, path)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
            texts = engine.decode(sizes, np.asarray(lists.flatten(), np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    chosen = encoded.select(F.col(id_column).alias("doc_id"), F.col(ids_column).alias("token_ids"))
    return chosen.mapInArrow(run, schema(chosen, "decoded binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", cache: int = CACHE_BYTES) -> DataFrame:
    """Rows (doc_id, packed binary, decoded binary): the ids of every text as little-endian unsigned 32-bit
    integers, and the bytes that these ids stand for. Both by one task; otherwise as ``encode`` and ``decode``. A worker
    remembers about ``cache`` bytes of chunks and words, which saves time and changes no result."""
    shared = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, engine = _cutter(shared, path, pattern, cache), _engine(shared, path)
        for batch in pieces(batches, limit=PIECE, holder="byte_bpe"):
            encoded = _encoded(cutter, batch.column(1))
            sizes = np.array([len(x) // 4 for x in encoded], np.int64)
            texts = engine.decode(sizes, np.frombuffer(b"".join(encoded), "<i4"))
            columns = [batch.column(0), pa.array(encoded, pa.binary()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "packed", "decoded"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema(chosen, "packed binary, decoded binary"))
