"""Finding and removing benchmark passages with an FM-index per shard of the training texts.

A task cuts its documents into shards of bounded size, maps words to numbers (words of no benchmark item,
and stretches too short to hold a window, become ends of records), builds an FM-index of the shard, searches
all windows of the items backwards in it, locates their occurrences and merges them to spans of words.
Nothing is shuffled. The items are sent to the tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, schema, whole_rows
from tidemark.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of benchmark text whose windows, at about ten times its bytes, are sent to the tasks at once
SHARD = 1 << 19  # symbols of an index

# Letters and digits of ASCII and every byte of other characters make words; A-Z are lower-cased.
SPACED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
FOUND = "n_words bigint, spans array<struct<first: bigint, last: bigint>>, item_ids array<string>"
SPANS = pa.list_(pa.struct({"first": pa.int64(), "last": pa.int64()}))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(SPACED).split()


class Phrases:
    """The windows of a block of items: distinct rows of word numbers by length, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        self.vocabulary: dict[bytes, int] = {}
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int32)
            if len(ids):
                length = min(window, len(ids))
                rows.setdefault(length, []).append(sliding_window_view(ids, length))
                owners.setdefault(length, []).append(np.full(len(ids) - length + 1, number[item], np.int32))
        self.by_length = []
        for length in sorted(rows):
            distinct, which = np.unique(np.concatenate(rows.pop(length)), axis=0, return_inverse=True)
            pairs = np.unique(which.astype(np.int64) << 32 | np.concatenate(owners.pop(length)))
            first = np.searchsorted(pairs >> 32, np.arange(len(distinct) + 1))
            self.by_length.append((length, distinct, first, (pairs & 0xFFFFFFFF).astype(np.int32)))
        self.shortest = min((x[0] for x in self.by_length), default=0)
        self.longest = max((x[0] for x in self.by_length), default=0)


def _shards(symbols: np.ndarray, overlap: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most SHARD symbols: cut at ends of records, or with an overlap inside a longer one."""
    start, n = 0, len(symbols)
    while n - start > SHARD:
        zeros = np.flatnonzero(symbols[start : start + SHARD] == 0)
        if len(zeros):
            end = following = start + int(zeros[-1]) + 1
        else:
            end, following = start + SHARD, start + SHARD - overlap
        yield start, end
        start = following
    if start < n:
        yield start, n


def _occurrences(texts: list[bytes | None], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; whether each word of all texts is hit; distinct rows (text number, item number)."""
    get, sizes, codes = phrases.vocabulary.get, [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        codes.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        codes.append(np.zeros(1, np.int64))
    every = np.concatenate(codes)
    sizes = np.array(sizes)
    # stretches of benchmark words long enough for a window, each with the end that follows it
    known = every != 0
    ends = np.flatnonzero(~known)
    run = np.diff(ends, prepend=-1) - 1
    long = np.zeros(len(every), bool)
    if phrases.shortest:
        long[ends] = run >= phrases.shortest
        long = np.repeat(long[ends], run + 1)
    place = np.flatnonzero(long)
    symbols = every[place]
    hit, pairs = np.zeros(len(every) + 1, np.int64), []
    owner_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    for a, b in _shards(symbols, phrases.longest - 1):
        part = symbols[a:b] if symbols[b - 1] == 0 else np.r_[symbols[a:b], 0]
        index = FMIndex(part, len(phrases.vocabulary) + 1)
        for length, rows, first_owner, owners in phrases.by_length:
            which, lo, hi = index.search(rows)
            many = hi - lo
            if not len(which):
                continue
            suffixes = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            at = place[a + index.locate(suffixes)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + length, -1)
            met = np.unique(np.c_[owner_of[at], np.repeat(which, many)], axis=0)
            count = first_owner[met[:, 1] + 1] - first_owner[met[:, 1]]
            spread = np.repeat(first_owner[met[:, 1]] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            pairs.append(np.unique(np.c_[np.repeat(met[:, 0], count), owners[spread]], axis=0))
    pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    return sizes, np.cumsum(hit)[:-1] > 0, pairs


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False]))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _blocks(benchmark: DataFrame, item_column: str, text_column: str) -> list[DataFrame]:
    """The items in blocks of about BLOCK_BYTES, by a hash of the id."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).cast("binary").alias("text"))
    items = items.where("item is not null and text is not null")
    n = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_BYTES
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def _shared_phrases(benchmark: DataFrame, window: int, item_column: str, text_column: str) -> list[Broadcast]:
    """The phrases of every block of items, whose size is bounded."""
    shared = []
    for block in _blocks(benchmark, item_column, text_column):
        rows = [(r["item"], bytes(r["text"])) for r in block.collect()]
        shared.append(benchmark.sparkSession.sparkContext.broadcast(Phrases(rows, window)))
    return shared


def _found(texts: list[bytes | None], blocks: list[Broadcast]) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
    """For each text its number of words, its spans of hit words and the items found, over all blocks. One step of
    Python does all: steps in a row would each take a task a worker, which an executor then keeps."""
    every, items = None, [set() for _ in texts]
    for phrases in blocks:
        sizes, hit, pairs = _occurrences(texts, phrases.value)
        every = hit if every is None else every | hit
        for doc, item in pairs.tolist():
            items[doc].add(phrases.value.items[item])
    spans, start = [], 0
    for n in sizes.tolist():
        own = every[start : start + n]
        spans.append([{"first": a, "last": b} for a, b in _spans(own)] if own.any() else [])
        start += n + 1
    return sizes, spans, list(map(sorted, items))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, with n_words, the spans of hit words (numbers of the
    first and last word, from 0) and the ids of the items found, as text.

    A null or empty text has no words. Items with a null id, or without a word, match nothing; an item of
    fewer words than a window matches as a whole. Repeated rows of either table do no harm: documents give
    a row each, items count once. An empty benchmark hits nothing.
    """
    blocks = _shared_phrases(benchmark, window, item_column, item_text_column)
    given = docs.select(whole_rows(docs).alias("doc"), as_bytes(text_column).alias("text"))
    out = schema(given, FOUND, "doc")
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, spans, items = _found(batch.column(1).to_pylist(), blocks)
            columns = [pa.array(sizes), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return given.mapInArrow(run, out)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """``docs`` with the hit words taken out of the text: a span goes from its first word's first byte to its
    last word's last byte. Texts without a hit stay as they are, byte for byte. Lower columns are untouched."""
    blocks = _shared_phrases(benchmark, window, item_column, item_text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(1).to_pylist()
            _, spans, _ = _found(texts, blocks)
            texts = [_without(text, own) if own else text for text, own in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc", "text"])

    given = docs.select(whole_rows(docs).alias("doc"), as_bytes(text_column).alias("text"))
    cleaned = given.mapInArrow(run, schema(given, "text string", "doc"))
    return cleaned.select(*(F.col("text" if c == text_column else f"doc.`{c}`").alias(c) for c in docs.columns))


def _without(text: bytes, spans: list[dict]) -> bytes:
    word = np.frombuffer(text.translate(SPACED), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, word, False]))
    kept, at = [], 0
    for s in spans:
        kept.append(text[at : edges[2 * s["first"]]])
        at = int(edges[2 * s["last"] + 1])
    return b"".join([*kept, text[at:]])
