"""Stupid-backoff scores by joins of n-gram count tables.

S(w | u) is c(u w) / c(u) where the pair was seen, else BACKOFF * c(w) / N; the first word of a text has c(w) / N. The count
tables of words and pairs are one table, partitioned by a hash of the n-gram. Texts ask for the counts that they need by rows
(n-gram, text, number), which are joined with the counts and summed per text.

Texts that are scored under their own counts have seen all their pairs: the table then leaves out pairs that occur once, and absence
says 1. Under the counts of another corpus absence says that a pair is unseen, and a text's score starts as if every pair backed
off; a pair in the table adds what it makes better.

Two things keep the exchange small, neither of which changes a result: the counts of the most frequent n-grams
go to every task (a table of fixed size), and a filter of fixed size tells most pairs that are not in the table. Under the texts' own
counts the n-grams are exchanged in ``PARTS`` parts by hash, one after the other, so that no more than a part is on disk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Staging, as_bytes, pieces, schema, staged
from tidemark.llm.recompression import BASE, cut, mixed, word_hashes
from tidemark.llm.simhash import LOWER
from tidemark.llm.substring_dedup import key_bits

BACKOFF = 0.4
HOT = 50_000  # most frequent words, and as many pairs, whose counts every task gets
FILTER_BITS = 25
PARTS = 2  # of the n-grams, exchanged one after the other
COUNTS = "h bigint, pair boolean, n bigint"
NEEDED = "h bigint, k1 bigint, k2 bigint, n int, value double"
ASKED = "h bigint, k1 bigint, k2 bigint, n int, value double, u bigint, w bigint"


def hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, of the pairs that end with them (0 for the first of a text), and the
    number of words per text. A-Z are lower-cased; words are what ASCII white space separates."""
    data, start, stop, sizes = cut([t and t.translate(LOWER) for t in texts])
    words = word_hashes(data, start, stop)[0]
    pairs = np.zeros(len(words), np.uint64)
    pairs[1:] = mixed(words[:-1] * BASE + mixed(words[1:]))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    pairs[first] = 0
    return words, pairs, sizes


def count_table(docs: DataFrame, text_column: str = "text", least: int = 1) -> DataFrame:
    """Rows (h, pair, n): how often every word occurs, and every pair that occurs at least ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=0):
            words, pairs, _ = hashed(batch.column(0).to_pylist())
            for some, pair in ((words, False), (pairs[pairs != 0], True)):
                keys, n = np.unique(some, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), pair)), pa.array(n)], ["h", "pair", "n"])

    rows = docs.select(as_bytes(text_column).alias("text")).mapInArrow(run, COUNTS)
    return rows.groupBy("h", "pair").agg(F.sum("n").alias("n")).where(~F.col("pair") | (F.col("n") >= least))


class Frequent:
    """Counts of frequent n-grams, looked up by hash."""

    def __init__(self, rows: pa.Table) -> None:
        keys = rows["h"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], np.log(rows["n"].to_numpy().astype(np.float64)[order])

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """The logarithms of the counts; NaN where the n-gram is not among the frequent."""
        out = np.full(len(hashes), np.nan)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[at] == hashes
            out[known] = self.logs[at[known]]
        return out


def _shared(counts: DataFrame) -> tuple[Broadcast, float]:
    """The counts of frequent words and pairs and the filter of pairs, for every task; and the number of words."""
    total = counts.where("not pair").agg(F.sum("n")).first()[0] or 1
    top = [counts.where(kind).orderBy(F.desc("n"), "h").limit(HOT).select("h", "n").toArrow() for kind in ("not pair", "pair")]
    bits = key_bits(counts.where("pair"), "h", FILTER_BITS)
    return counts.sparkSession.sparkContext.broadcast((Frequent(top[0]), Frequent(top[1]), bits)), float(total)


def _may_be(bits: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    place = pairs & np.uint64((1 << FILTER_BITS) - 1)
    return (pairs != 0) & ((bits[place >> np.uint64(5)] >> (pairs & np.uint64(31)).astype(np.uint32)) & np.uint32(1)).astype(bool)


def _of_part(hashes: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Whether n-grams are of a part."""
    return (hashes >> np.uint64(32)) % np.uint64(parts) == part


def _needed(keyed: DataFrame, shared: Broadcast, total: float, part: int, parts: int) -> DataFrame:
    """Rows NEEDED under the texts' own counts, for the n-grams of a part: a text's score is the sum of n * log(count of h) + value over
    all parts, the count being 1 where the table has none. In the first part a text with words has one row with its value, under a
    key of its own, whose count is not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, frequent_pairs, bits = shared.value
        for batch in pieces(batches, text=2, limit=1 << 20):
            words, pairs, sizes = hashed(batch.column(2).to_pylist())
            if not len(words):
                continue
            text = np.repeat(np.arange(len(sizes)), sizes)
            first, known, both = pairs == 0, frequent(words), frequent_pairs(pairs)
            maybe = _may_be(bits, pairs)
            # the word that a position divides by: the one before, for the first of a text all words
            previous, before = np.r_[np.uint64(0), words[:-1]], np.r_[np.nan, known[:-1]]
            base = np.where(first, np.nan_to_num(known) - np.log(total), np.where(maybe, np.nan_to_num(both), 0.0) - np.nan_to_num(before))
            ends = np.flatnonzero(sizes)
            base = np.add.reduceat(base, (np.cumsum(sizes) - sizes)[ends])
            here = _of_part(words, part, parts)
            plus, minus = first & np.isnan(known) & here, ~first & np.isnan(before) & np.r_[False, here[:-1]]
            ask = maybe & np.isnan(both) & _of_part(pairs, part, parts)
            h = np.concatenate([words[plus], previous[minus], pairs[ask]])
            owner = np.concatenate([text[plus], text[minus], text[ask]])
            n = np.concatenate([np.ones(plus.sum()), -np.ones(minus.sum()), np.ones(ask.sum())]).astype(np.int32)
            if len(h):  # an n-gram is asked for once in a text
                order = np.lexsort((h, owner))
                h, owner, n = h[order], owner[order], n[order]
                start = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
                h, owner, n = h[start], owner[start], np.add.reduceat(n, start).astype(np.int32)
            if part:
                ends, base = ends[:0], base[:0]
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            columns = [np.r_[k1[ends], h.view(np.int64)], np.r_[k1[ends], k1[owner]], np.r_[k2[ends], k2[owner]]]
            columns += [np.r_[np.zeros(len(ends), np.int32), n], np.r_[base, np.zeros(len(h))]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["h", "k1", "k2", "n", "value"])

    return keyed.select("k1", "k2", "text").mapInArrow(run, NEEDED)


def _asked(keyed: DataFrame, counts: DataFrame, backoff: float) -> DataFrame:
    """Rows ASKED: what the count of ``h`` is needed for. A row's text gets n * log(count) + value; for the
    pairs of rarer words, less n times the logarithms of the counts of u and w as well."""
    shared, total = _shared(counts)
    log_total, log_backoff = float(np.log(total)), float(np.log(backoff))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, frequent_pairs, bits = shared.value
        for batch in pieces(batches, text=2, limit=1 << 20):
            words, pairs, sizes = hashed(batch.column(2).to_pylist())
            if not len(words):
                continue
            text = np.repeat(np.arange(len(sizes)), sizes)
            first = pairs == 0
            known = frequent(words)
            # as if every pair backed off; what a rarer word lacks is asked for below
            base = np.where(first, 0.0, log_backoff) - log_total + np.nan_to_num(known)
            ends = np.flatnonzero(sizes)
            start = np.cumsum(sizes) - sizes
            rare = np.isnan(known)
            maybe = _may_be(bits, pairs)
            before = np.r_[np.nan, known[:-1]]
            gain = -np.nan_to_num(before) - log_backoff - np.nan_to_num(known) + log_total
            both = frequent_pairs(pairs)
            settled = maybe & ~np.isnan(both) & ~rare & ~np.isnan(before)
            base[settled] += both[settled] + gain[settled]
            base = np.add.reduceat(base, start[ends])
            ask = np.flatnonzero(maybe & ~settled)
            previous = np.r_[np.uint64(0), words[:-1]]
            # a row for the first word of every text carries its base and is always answered
            lead = start[ends]
            rares = np.flatnonzero(rare)
            h = np.concatenate([words[lead], words[rares], pairs[ask]])
            owner = np.concatenate([ends, text[rares], text[ask]])
            n = np.concatenate([np.zeros(len(ends)), np.ones(len(rares) + len(ask))]).astype(np.int32)
            value = np.concatenate([base, np.zeros(len(rares)), gain[ask]])
            no = np.ones(len(ends) + len(rares), bool)
            u = pa.array(np.r_[np.zeros(len(no), np.int64), previous[ask].view(np.int64)], mask=np.r_[no, ~np.isnan(before[ask])])
            w = pa.array(np.r_[np.zeros(len(no), np.int64), words[ask].view(np.int64)], mask=np.r_[no, ~rare[ask]])
            keys = [pa.array(np.asarray(batch.column(i))[owner]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *keys, pa.array(n), pa.array(value), u, w], ["h", "k1", "k2", "n", "value", "u", "w"])

    return keyed.select("k1", "k2", "text").mapInArrow(run, ASKED)


def _own_scores(stage: Staging, keyed: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """Rows (k1, k2, value) under the texts' own counts."""
    counts = stage.put(count_table(docs, text_column, least=2), "counts")
    shared, total = _shared(counts)
    value = F.sum(F.col("n") * F.coalesce("log_n", F.lit(0.0)) + F.col("value")).alias("value")
    sums = []
    for part in range(PARTS):
        table = counts.where(F.pmod(F.shiftrightunsigned("h", 32), F.lit(PARTS)) == part).select("h", F.ln("n").alias("log_n"))
        joined = _needed(keyed, shared, total, part, PARTS).join(table, "h", "left")
        sums.append(stage.put(joined.groupBy("k1", "k2").agg(value), "sums"))
    totals = stage.put(reduce(DataFrame.union, sums).groupBy("k1", "k2").agg(F.sum("value").alias("value")), "totals")
    stage.drop(counts, *sums)
    return totals


def _scores_under(stage: Staging, keyed: DataFrame, corpus: DataFrame, backoff: float, text_column: str) -> DataFrame:
    """Rows (k1, k2, value) under the counts of another corpus. A word that it does not hold counts as if seen once."""
    counts = count_table(corpus, text_column).unionByName(_unseen(keyed, corpus, text_column))
    counts = stage.put(counts, "counts")
    table = counts.select("h", F.ln("n").alias("log_n"))
    joined = _asked(keyed, counts, backoff).join(table, "h")
    sums = joined.groupBy("k1", "k2", "u", "w").agg(F.sum(F.col("n") * F.col("log_n") + F.col("value")).alias("value"), F.sum("n").alias("n"))
    sums = stage.put(sums, "sums")
    parts = [sums.select("k1", "k2", "value")]
    for word in ("u", "w"):
        more = sums.where(F.col(word).isNotNull()).select("k1", "k2", F.col(word).alias("h"), "n")
        parts.append(more.join(table, "h").select("k1", "k2", (-F.col("n") * F.col("log_n")).alias("value")))
    total = stage.put(parts[0].union(parts[1]).union(parts[2]).groupBy("k1", "k2").agg(F.sum("value").alias("value")), "totals")
    stage.drop(counts, sums)
    return total


def _unseen(keyed: DataFrame, corpus: DataFrame, text_column: str) -> DataFrame:
    """Rows (h, pair, n = 1) of the texts' words that the corpus lacks."""
    own = count_table(keyed, "text").where("not pair").select("h")
    seen = count_table(corpus, text_column).where("not pair").select("h")
    return own.join(seen, "h", "left_anti").select("h", F.lit(False).alias("pair"), F.lit(1).cast("bigint").alias("n"))


def log_scores(docs: DataFrame, corpus: DataFrame | None = None, backoff: float = BACKOFF, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, log_score), one for each row of ``docs``: the sum of the natural logarithms of
    the scores of its words, under counts of all texts of the corpus, by default ``docs`` itself. A word that another corpus lacks
    counts as if it were there once.

    Null and empty texts have no words and the score 0. Repeated rows count as often as they occur and get a row
    each; null and repeated ids are kept; other columns are not looked at. An empty table gives no rows.
    """
    stage, text, key = Staging(docs.sparkSession), F.col(text_column), F.col(id_column)
    keyed = docs.select(key.alias("doc_id"), F.xxhash64(text, F.lit(1), key).alias("k1"), F.xxhash64(F.lit(2), key, text).alias("k2"), text.cast("binary").alias("text"))
    if corpus is None:
        total = _own_scores(stage, keyed, docs, text_column)
    else:
        total = _scores_under(stage, keyed, corpus, backoff, text_column)
    copies = keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies"))  # alike in id and text
    scores = staged(total.join(copies, ["k1", "k2"]).select("k1", "k2", (F.col("value") / F.col("copies")).alias("log_score")), "scores")
    stage.drop(total)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=3):
            n = pa.array([len((t or b"").split()) for t in batch.column(3).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], n], ["doc_id", "k1", "k2", "n_words"])

    rows = keyed.mapInArrow(sizes, schema(keyed, "k1 bigint, k2 bigint, n_words bigint"))
    return rows.join(scores, ["k1", "k2"], "left").select("doc_id", "n_words", F.coalesce("log_score", F.lit(0.0)).alias("log_score"))
