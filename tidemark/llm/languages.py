"""Languages of texts as mixtures.

A model holds, for every language, the smoothed frequency of hashed byte n-grams within words. For a text, a word's
likelihood in a language is the product over its n-grams; expectation-maximisation estimates the
proportions of the languages among the words, for nested sets of languages, and the set with the best
likelihood less a penalty for every language is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, schema

GRAM = 3  # bytes
BUCKET_BITS = 16
MOST_LANGUAGES = 512  # rows of the model that tasks get
SMOOTHING = 0.5
STEPS = 30  # of expectation-maximisation at most
STILL = 1e-4  # largest change of a proportion at which it has converged
PENALTY = 3.0  # of a further language, in units of half the logarithm of the number of words
NONE = "und"

# A-Z become small, ASCII characters that are no letters become spaces, other bytes stay.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams that start in a word, which word of all texts each is of, and the words per text.
    Every word has a space before and behind it; a text of several lines is one row of words."""
    words = [(t or b"").translate(LETTERS).split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    # zeros part the texts, so that no n-gram reaches into the next
    joined = b"".join(b" " + b" ".join(some) + b" " + bytes(GRAM) for some in words if some)
    x = np.frombuffer(joined, np.uint8).astype(np.uint32)
    n = len(x) - GRAM
    if n <= 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    key = np.zeros(n, np.uint32)
    for i in range(GRAM):
        key = key << 8 | x[i : i + n]
    hashed = (key * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    # the n-gram at i belongs to the word that i's character is of, or that follows the space at i
    space, last = x[:n] == 32, x[1 : n + 1] == 0
    word = np.cumsum(space & ~last) - 1
    keep = (x[:n] != 0) & ~(space & last)
    return hashed[keep].astype(np.int64), word[keep], counts


def count_grams(docs: DataFrame, language: str = "lang", text_column: str = "text") -> DataFrame:
    """Rows (lang, bucket, n): n-grams of all texts by language, without rows that lack either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(iter([batch])):
                names = np.array(part.column(0).to_pylist(), object)
                for name in sorted(set(names.tolist())):
                    own = [t for t, x in zip(part.column(1).to_pylist(), names, strict=True) if x == name]
                    buckets = grams(own)[0]
                    totals.setdefault(name, np.zeros(1 << BUCKET_BITS, np.int64))[:] += np.bincount(buckets, minlength=1 << BUCKET_BITS)
            if len(totals) > 16:
                yield from _rows(totals)
                totals = {}
        yield from _rows(totals)

    known = docs.select(F.col(language).cast("string").alias("lang"), as_bytes(text_column).alias("text"))
    known = known.where("lang is not null and text is not null")
    return known.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _rows(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, counts in totals.items():
        some = np.flatnonzero(counts)
        columns = [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


@dataclass
class Model:
    """``log_p[b, k]``: logarithm of the probability of bucket b in language ``names[k]``."""

    names: list[str]
    log_p: np.ndarray


def fit(docs: DataFrame, language: str = "lang", text_column: str = "text") -> Model:
    """The model of the labelled texts. It has a column for each language, as wide as the buckets; more
    languages than MOST_LANGUAGES raise."""
    counts = count_grams(docs, language, text_column).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("buckets"))
    rows = counts.limit(MOST_LANGUAGES + 1).toLocalIterator()
    names, columns = [], []
    for row in rows:  # a row has at most as many entries as there are buckets
        if len(names) == MOST_LANGUAGES:
            raise ValueError("too many languages for one model")
        column = np.full(1 << BUCKET_BITS, SMOOTHING)
        buckets = np.array([tuple(b) for b in row["buckets"]], np.int64).reshape(-1, 2)
        column[buckets[:, 0]] += buckets[:, 1]
        names.append(row["lang"])
        columns.append(np.log(column / column.sum()).astype(np.float32))
    order = sorted(range(len(names)), key=names.__getitem__)
    return Model([names[i] for i in order], np.array([columns[i] for i in order], np.float32).reshape(len(names), 1 << BUCKET_BITS).T.copy())


def _mixture(likelihood: np.ndarray, owner: np.ndarray, counts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text by expectation-maximisation. ``likelihood``: by word and
    language, the best language of a word being 1; ``allowed``: by text and language. Each text stops when its own proportions
    stand still, so that they do not depend on the texts beside it."""
    shares = allowed / allowed.sum(1, keepdims=True)
    going, rows = np.arange(len(counts)), np.arange(len(owner))  # texts that still move, and their words
    for _ in range(STEPS):
        some = counts[going]
        mixed = likelihood[rows] * shares[owner[rows]]
        mixed /= np.maximum(mixed.sum(1), 1e-300)[:, None]
        new = np.add.reduceat(mixed, np.cumsum(some) - some, axis=0) / some[:, None]
        moves = np.abs(new - shares[going]).max(1) >= STILL
        shares[going] = new
        rows, going = rows[np.repeat(moves, some)], going[moves]
        if not len(going):
            break
    total = np.maximum((likelihood * shares[owner]).sum(1), 1e-300)
    return shares, np.add.reduceat(np.log(total), np.cumsum(counts) - counts)


def infer(texts: list[bytes | None], model: Model) -> list[dict[str, float]]:
    """The languages of each text and their proportions, largest first. Texts without a word, and all texts
    under a model without languages, get none."""
    out: list[dict[str, float]] = [{} for _ in texts]
    buckets, word, counts = grams(texts)
    some = np.flatnonzero(counts)
    k = len(model.names)
    if not len(some) or not k:
        return out
    first = np.flatnonzero(np.diff(word, prepend=-1))
    score = np.add.reduceat(model.log_p[buckets], first, axis=0).astype(np.float64)
    counts = counts[some]
    owner = np.repeat(np.arange(len(some)), counts)
    top = score.max(1)
    # a word that fits no language better than chance says nothing: differences are bounded
    relative = np.maximum(score - top[:, None], -30.0)
    starts = np.cumsum(counts) - counts
    single = np.add.reduceat(relative, starts, axis=0)
    chosen = single.argmax(1)
    best = single[np.arange(len(some)), chosen]
    shares = np.zeros((len(some), k))
    shares[np.arange(len(some)), chosen] = 1.0
    cost = PENALTY * 0.5 * np.log(counts + 1.0)
    if k > 1:
        # no set can beat the best language of every word, whose relative log-likelihood is 0
        open_ = np.flatnonzero(best + cost < 0)
        if len(open_):
            rows = np.isin(owner, open_)
            near, own, sizes = np.exp(relative[rows]), np.repeat(np.arange(len(open_)), counts[open_]), counts[open_]
            every, limit = _mixture(near, own, sizes, np.ones((len(open_), k)))
            ranked = np.argsort(-every, axis=1, kind="stable")
            for m in range(2, k + 1):
                # neither can it beat the likelihood of the mixture of all languages
                worth = np.flatnonzero(limit - (m - 1) * cost[open_] > best[open_])
                if not len(worth):
                    break
                allowed = np.zeros((len(open_), k))
                np.put_along_axis(allowed, ranked[:, :m], 1.0, axis=1)
                mine = np.isin(own, worth)
                part, value = _mixture(near[mine], np.repeat(np.arange(len(worth)), sizes[worth]), sizes[worth], allowed[worth])
                value = value - (m - 1) * cost[open_[worth]]
                better = value > best[open_[worth]]
                best[open_[worth[better]]] = value[better]
                shares[open_[worth[better]]] = part[better]
    for i, row in zip(some.tolist(), shares, strict=True):
        out[i] = {model.names[j]: float(row[j]) for j in np.argsort(-row, kind="stable") if row[j] > 0}
    return out


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score, languages map<string,double>): the language with the largest
    proportion, that proportion, and the whole mixture.

    Null and empty texts and texts without a letter get ``und``, score 0 and no languages; so do all texts
    if nothing was learned. Letters outside ASCII are told from other characters per text. Repeated rows
    and ids give a row each, a null id is kept, other columns are not looked at, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the buckets and MOST_LANGUAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=1 << 20):
            texts = batch.column(1).to_pylist()
            texts = [t if t is not None and any(map(str.isalpha, t)) else None for t in texts]
            mixtures = infer([t and t.encode() for t in texts], shared.value)
            tops = [next(iter(m.items()), (NONE, 0.0)) for m in mixtures]
            columns = [
                batch.column(0),
                pa.array([name for name, _ in tops], pa.string()),
                pa.array([min(1.0, share) for _, share in tops], pa.float64()),
                pa.array([list(m.items()) for m in mixtures], pa.map_(pa.string(), pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "languages"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema(chosen, "lang_pred string, score double, languages map<string, double>"))


def learnable(held_out: Column, language: str = "lang") -> Column:
    return ~held_out & F.col(language).isNotNull()
