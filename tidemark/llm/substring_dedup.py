"""Removing passages that occur more than once in a corpus.

Recompression gives every window of words an anchor, a symbol inside it that equal windows share. Neighbouring
windows with one anchor travel as one row. Spark counts the anchors over the whole corpus; where one
occurs once, its windows are unique. Rows of an anchor that agree in all the words around it are repeats.
Only where occurrences agree in part are windows compared one by one. Names and comparisons are hashes of
128 bits in total.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Staging, pieces, schema, staged, whole_rows
from tidemark.llm.recompression import Prefixes, anchors, marked, mixed

WINDOW = 35
FILTER_BITS = 24  # of the filter that spares texts without repeats the shuffle: 2 MB at any size of corpus
KEYS = ["k1", "k2"]
PIECE = 1 << 18  # bytes of text that are worked on at once
PART = 8  # windows that are compared by what they have in common, before each is
ROWS = "k1 bigint, k2 bigint, name bigint, around bigint, first int, n int, place int"
PARTS = "k1 bigint, k2 bigint, name bigint, core bigint, first int, windows array<bigint>"
KEPT = "n_words bigint, n_removed bigint, kept_text string"


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of documents with a 128-bit key of id and text. Rows with one key are alike in both, so that
    what is found for the key holds for each."""
    text, key = F.col(f"`{text_column}`"), F.col(f"`{id_column}`")
    doc = whole_rows(docs).alias("doc")
    return docs.select(F.xxhash64(text, F.lit(1), key).alias("k1"), F.xxhash64(F.lit(2), key, text).alias("k2"), text.cast("binary").alias("text"), doc)


def _anchor_rows(keyed: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=2, limit=PIECE):
            both, end, begin = marked(batch.column(2).to_pylist())
            name, first, last, place = anchors(both[0], end, window)
            around = Prefixes(both[1])(first, last + window - 1)
            text = np.searchsorted(begin, first, side="right") - 1
            keys = [np.asarray(batch.column(i))[text] for i in (0, 1)]
            columns = [*keys, name.view(np.int64), around.view(np.int64), *(x.astype(np.int32) for x in (first - begin[text], last - first + 1, place - begin[text]))]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["k1", "k2", "name", "around", "first", "n", "place"])

    return keyed.select("k1", "k2", "text").mapInArrow(run, ROWS)


def _parts(asked: DataFrame, window: int) -> DataFrame:
    """The windows in ``groups`` of every text, in parts of at most PART neighbours: their hashes, and one of
    the words that all of the part have in common. Parts are cut at fixed distances from the anchor, so
    that equal windows are in parts with equal cores."""
    most = min(PART, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=2, limit=PIECE):
            both, _, begin = marked(batch.column(2).to_pylist())
            prefixes = Prefixes(both[1])
            lists = batch.column(3)
            text = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            flat = lists.flatten()
            first, n, place = (np.asarray(flat.field(k)).astype(np.int64) for k in ("first", "n", "place"))
            group = np.repeat(np.arange(len(n)), n)
            at = begin[text[group]] + first[group] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            anchor = begin[text[group]] + place[group]
            part = (anchor - at) // most
            start = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (group[1:] != group[:-1])][: len(at)])
            common = anchor[start] - most * part[start]
            core = prefixes(common, common + window - most)
            owner = text[group[start]]
            name = np.asarray(flat.field("name"))[group[start]]
            offsets = np.r_[start, len(at)].astype(np.int32)
            columns = [
                *(pa.array(np.asarray(batch.column(i))[owner]) for i in (0, 1)),
                pa.array(name),
                pa.array((mixed(name.view(np.uint64)) ^ core).view(np.int64)),
                pa.array((at[start] - begin[owner]).astype(np.int32)),
                pa.ListArray.from_arrays(offsets, prefixes(at, at + window - 1).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "name", "core", "first", "windows"])

    return asked.mapInArrow(run, PARTS)


def key_bits(keys: DataFrame, key: str, size: int = FILTER_BITS) -> np.ndarray:
    """2**size bits, in words of 32, of which those are set that the lowest bits of the keys name."""
    place = F.col(key).bitwiseAND(F.lit((1 << size) - 1))
    word, bit = F.shiftright(place, 5).alias("word"), F.expr(f"shiftleft(1L, cast({key} & 31 as int))").alias("bit")
    rows = keys.select(word, bit).groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # one per word at most
    bits = np.zeros(1 << (size - 5), np.uint32)
    bits[rows["word"].to_numpy().astype(np.int64)] = rows["bits"].to_numpy().astype(np.uint32)
    return bits


def _shared_bits(keys: DataFrame, key: str) -> Broadcast:
    return keys.sparkSession.sparkContext.broadcast(key_bits(keys, key))


def _among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each of the hashes may be one of the keys. Wrong only by saying yes too often."""
    return (bits[(hashes & ((1 << FILTER_BITS) - 1)) >> 5] >> (hashes & 31).astype(np.uint32)) & 1 == 1


def _filter(shared: Broadcast, key: str) -> Column:
    """Whether the column may be one of the keys, which are hashes; what it lets pass is joined."""

    @F.pandas_udf("boolean")
    def may_be(hashes: pd.Series) -> pd.Series:
        return pd.Series(_among(shared.value, hashes.to_numpy(np.int64)))

    return may_be(key)


def repeated_windows(keyed: DataFrame, window: int) -> DataFrame:
    """Rows (k1, k2, groups): for every text with repeats, its stretches of repeated windows."""
    stage = Staging(keyed.sparkSession)
    rows = stage.put(_anchor_rows(keyed, window), "anchors")
    names = rows.groupBy("name").agg(F.count("*").alias("c"), F.min("around").alias("lo"), F.max("around").alias("hi"))
    names = stage.put(names.where("c > 1").select("name", (F.col("lo") == F.col("hi")).alias("same")), "repeated-names")
    met = stage.put(rows.join(names, "name"), "candidates")
    stage.drop(rows, names)
    partly, key = met.where("not same"), F.struct("k1", "k2", "first")
    contexts = partly.groupBy("name", "around").agg(F.count("*").alias("c"), F.min(key).alias("one"))
    contexts = stage.put(contexts.where("c > 1"), "repeated-contexts")
    told = stage.put(partly.join(contexts, ["name", "around"], "left").drop("around", "same"), "compared")
    sure = stage.put(met.where("same").select(*KEYS, "first", "n").union(told.where("c > 1").select(*KEYS, "first", "n")), "sure")
    stage.drop(met, contexts)
    # one place stands for all that agree in everything; the others are compared with it
    asked = told.where(F.col("c").isNull() | (key == F.col("one")))
    asked = asked.select(*KEYS, "name", "first", "n", "place").distinct()  # rows alike in id and text are one
    asked = stage.put(asked.groupBy(*KEYS).agg(F.collect_list(F.struct("name", "first", "n", "place")).alias("groups")), "asked")
    stage.drop(told)
    texts = keyed.where(_filter(_shared_bits(asked, "k1"), "k1")).groupBy(*KEYS).agg(F.first("text").alias("text"))
    parts = stage.put(_parts(texts.join(asked, KEYS), window), "parts")
    stage.drop(asked)
    cores = stage.put(parts.groupBy("core").agg(F.count("*").alias("c")).where("c > 1").select("core"), "repeated-cores")
    left = parts.where(_filter(_shared_bits(cores, "core"), "core")).join(cores, "core")
    windows = left.select(*KEYS, "name", "first", F.posexplode("windows").alias("i", "window"))
    windows = stage.put(windows.select(*KEYS, "name", (F.col("first") + F.col("i")).alias("first"), "window"), "windows")
    stage.drop(parts, cores)
    equal = windows.groupBy("name", "window").agg(F.count("*").alias("c"))
    equal = stage.put(equal.where("c > 1").select("name", "window"), "equal-windows")
    found = windows.join(equal, ["name", "window"]).select(*KEYS, "first", F.lit(1).alias("n"))
    every = sure.union(found).groupBy(*KEYS).agg(F.collect_set(F.struct("first", "n")).alias("groups"))
    out = staged(every, "repeats")
    stage.drop(sure, windows, equal)
    return out


def without_repeats(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, with n_words, n_removed and kept_text: the words that no
    repeated window covers, joined by one space.

    Words are what ASCII white space separates. A window is repeated if its words also start anywhere else,
    in the same text or another. Null and empty texts, and texts shorter than a window, lose nothing;
    kept_text is then their words, for a null text empty. Repeated rows are copies of each other, so that each
    loses all its windows. Ids may be null or repeated. An empty table gives no rows.
    """
    keyed = _keyed(docs, id_column, text_column)
    repeats = repeated_windows(keyed, window)
    groups = "array<struct<first: int, n: int>>"
    shared = _shared_bits(repeats, "k1")
    every = keyed.select("text", F.lit(None).cast(groups).alias("groups"), "doc", "k1")
    hit = keyed.where(_filter(shared, "k1")).join(repeats, KEYS, "left").select("text", "groups", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=0, limit=PIECE):
            counts, removed, kept = [], [], []
            for text, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text or b"").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if found.is_valid and len(found.values):
                    first, n = (np.asarray(found.values.field(k)).astype(np.int64) for k in ("first", "n"))
                    np.add.at(gone, first, 1)
                    np.add.at(gone, first + n + window - 1, -1)
                    stays = np.cumsum(gone)[:-1] == 0
                    left = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                else:
                    left = words
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            strings = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), strings], ["doc", "n_words", "n_removed", "kept_text"])

    def run_clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a filter of its own before this step would take each task a second Python worker, which an executor then keeps
        return run(batch.filter(pa.array(~_among(shared.value, np.asarray(batch.column(3))))) for batch in batches)

    out = schema(keyed, KEPT, "doc")
    return every.mapInArrow(run_clear, out).union(hit.mapInArrow(run, out))
