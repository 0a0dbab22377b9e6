"""A quality classifier learned from trusted positives and unlabelled texts.

The features describe form rather than language: hashed trigrams of the text's shape (runs of small letters,
capitals, digits, single marks), and shares of repeated words and lines. A linear model minimises the
non-negative unbiased risk: prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]), with the logistic loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, schema

SHAPE_BITS = 9
POSITIVES, UNLABELLED = 8_000, 16_000  # rows at most that the model is fitted on
STEPS, RATE, DECAY = 400, 0.02, 1e-4
UNKNOWN = 0.5  # score when nothing was learned

# small letters and bytes outside ASCII, capitals, digits, white space; every mark is a shape of its own
_SHAPES = np.array(
    [1 if 97 <= b <= 122 or b >= 128 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b == 32 or 9 <= b <= 13 else b for b in range(256)],
    np.uint32,
)
_PLAIN = 8
SIZE = (1 << SHAPE_BITS) + _PLAIN


def features(text: bytes | None) -> np.ndarray:
    """Shares of shape trigrams, then of capitals, digits, marks, words that repeat the one before, words and
    lines that are not new, and the logarithms of the mean word length and the number of words. A text
    without words has zeros."""
    out = np.zeros(SIZE, np.float32)
    words = (text or b"").split()
    if not words:
        return out
    shape = _SHAPES[np.frombuffer(text, np.uint8)]
    counts = np.bincount(np.minimum(shape, 5), minlength=6)
    runs = shape[np.r_[True, shape[1:] != shape[:-1]]]
    if len(runs) > 2:
        key = (runs[:-2] << 16 | runs[1:-1] << 8 | runs[2:]) * np.uint32(2654435761) >> np.uint32(32 - SHAPE_BITS)
        out[: 1 << SHAPE_BITS] = np.sqrt(np.bincount(key, minlength=1 << SHAPE_BITS) / len(key))
    n, lines = len(words), text.split(b"\n")
    out[1 << SHAPE_BITS :] = (
        counts[2] / len(text),
        counts[3] / len(text),
        counts[5] / len(text),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(words)) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(text) / n),
        np.log1p(n) / 4,
    )
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes | None]) -> list[float]:
        """Probability-like scores in 0 .. 1."""
        margins = (float(features(t) @ self.weights) + self.bias for t in texts)
        return [float(1 / (1 + np.exp(-np.clip(m, -60, 60)))) for m in margins]


def risk_minimiser(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """The linear model of least non-negative risk, by Adam over all given rows. Where the estimate of the
    negative risk falls below zero, a step goes back along it instead."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(SIZE, np.float32), float(np.log(UNKNOWN / (1 - UNKNOWN))))
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    w, b = np.zeros(SIZE, np.float32), np.float32(0)
    m1, m2 = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for step in range(1, STEPS + 1):
        gp, gu = p @ w + b, u @ w + b
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        on_p, on_u = -prior * sigmoid(gp) / len(p), sigmoid(gu) / len(u)
        if negative >= 0:
            on_p = on_p - prior * sigmoid(-gp) / len(p)
        else:
            on_p, on_u = -on_p, -on_u
        grad = np.r_[on_p @ p + on_u @ u + DECAY * w, on_p.sum() + on_u.sum()]
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), np.float32(b - move[-1])
    weights = w / scale
    return Model(weights.astype(np.float32), float(b - mean @ weights))


def _sample(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` ids that come first by a hash: the same on any number of machines."""
    return rows.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _matrix(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=0):
            rows = [features(t).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["x"])

    # ids of a bounded sample, and of many rows of one id the one that comes first by a hash
    chosen = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    chosen = chosen.select("text")
    rows = chosen.mapInArrow(run, "x binary").toArrow().column(0).to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, SIZE)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, positives: int = POSITIVES, unlabelled: int = UNLABELLED, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """The model of documents whose label is 1 against all documents, over rows that ``allowed`` (an
    expression of doc_id) holds for.

    It is fitted on at most ``positives`` and ``unlabelled`` documents, the first by a hash of the id; the
    prior is the share of label 1 among all allowed labels. Null labels and ids are left out, repeated labels count
    once, of several rows with one id one is learned from, a document with both labels counts for both. Without positives or documents the model
    scores every text alike.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), as_bytes(text_column).alias("text")).where(allowed)
    marks = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("label")).where(allowed).where("label in (0, 1)").distinct()
    prior = marks.agg(F.avg("label")).first()[0]
    if not prior:
        return risk_minimiser(np.zeros((0, SIZE)), np.zeros((0, SIZE)), UNKNOWN)
    trusted = _sample(marks.where("label = 1"), positives)
    return risk_minimiser(_matrix(texts, trusted), _matrix(texts, _sample(texts, unlabelled)), float(prior))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, score), one for each row of ``docs``. Null and empty texts get the score of a text without
    words. Null and repeated ids are kept, other columns not looked at, an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = shared.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), as_bytes(text_column).alias("text"))
    return chosen.mapInArrow(run, schema(chosen, "score double"))
