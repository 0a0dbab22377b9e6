"""Exact top-k search by inner product in a pivot-distance index.

With one more component that makes all vectors equally long, the largest inner products are the smallest
Euclidean distances. Every vector is keyed by its nearest pivot and its distance to it; vectors of a pivot are
sorted into annuli, which are cut into blocks of bounded size. By the triangle inequality, what is within a radius of
a query lies in the annuli within this radius of its own distance to each pivot. The radius doubles in every wave, which
visits the annuli that it adds; a query stops when its k-th best lies within the radius. Scores are integers and exact; distances only order and
exclude, with a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

PIVOTS = 32
SAMPLE = 4096  # vectors that pivots are chosen from
WIDTH = 1 / 32  # of an annulus, as a share of the longest vector
BLOCK = 1024  # vectors in a block on average
QUERIES = 256  # queries that meet a block at once
EXACT = float(1 << 53)  # below which sums of products of integers are exact as doubles


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, odd), F.lit(False))


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component x, as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = np.asarray(lists.flatten(), np.int64)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with those of ``b``."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _keys(vectors: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all pivots from vectors lengthened to ``reach``; and the squares of the lengths."""
    x = vectors.astype(np.float64)
    squares = (x * x).sum(1)
    own = np.sqrt(np.maximum(reach * reach - squares, 0.0))
    p = pivots.astype(np.float64)
    p_squares = (p * p).sum(1)
    p_own = np.sqrt(np.maximum(reach * reach - p_squares, 0.0))
    far = squares[:, None] + own[:, None] ** 2 + (p_squares + p_own**2)[None] - 2 * (x @ p.T + own[:, None] * p_own[None])
    return np.sqrt(np.maximum(far, 0.0)), squares


class Index:
    """Blocks (block, pivot, ids, vectors) and their annuli (block, pivot, low, high, n) for vectors of one
    dimension, with the pivots and the length of the longest vector."""

    def __init__(self, vectors: DataFrame, pivots: int = PIVOTS) -> None:
        self.reach = float(vectors.agg(F.max(F.sqrt(_square("vector")))).first()[0] or 0.0) * (1 + 1e-9) + 1.0
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).select("vector").collect()
        self.pivots = self._spread(np.array([r[0] for r in sample], np.int64).reshape(len(sample), len(sample[0][0]) if sample else 0), pivots)
        annuli = self._placed(vectors.select("vec_id", "vector"))
        counts = annuli.groupBy("pivot", "annulus").agg(F.count("*").alias("n"))
        blocks = staged(counts.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n"), "annuli")
        part = F.pmod(F.xxhash64("vec_id", "vector"), "parts").cast("int")
        packed = annuli.join(blocks, ["pivot", "annulus"]).groupBy("pivot", "annulus", part.alias("part"))
        row = F.struct("vec_id", "vector", "distance")
        packed = packed.agg(F.collect_list(row).alias("rows"), F.min("distance").alias("low"), F.max("distance").alias("high"))
        self.blocks = staged(packed.withColumn("n", F.size("rows")), "blocks")

    def _spread(self, sample: np.ndarray, pivots: int) -> np.ndarray:
        """Vectors far from each other: each is the farthest from those before."""
        chosen = [0] if len(sample) else []
        nearest = np.full(len(sample), np.inf)
        while chosen and len(chosen) < pivots:
            nearest = np.minimum(nearest, _keys(sample, sample[chosen[-1:]], self.reach)[0][:, 0])
            if nearest.max() <= 0:
                break
            chosen.append(int(nearest.argmax()))
        return sample[chosen]

    def _placed(self, vectors: DataFrame) -> DataFrame:
        shared, reach = vectors.sparkSession.sparkContext.broadcast(self.pivots), self.reach

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                far = _keys(_matrix(batch.column(1)), shared.value, reach)[0]
                pivot = far.argmin(1)
                distance = far[np.arange(len(far)), pivot]
                annulus = np.floor(distance / (reach * WIDTH)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(annulus), pa.array(distance)], ["vec_id", "vector", "pivot", "annulus", "distance"])

        return vectors.mapInArrow(run, "vec_id bigint, vector array<bigint>, pivot int, annulus int, distance double")

    def distances(self, queries: DataFrame) -> DataFrame:
        """Rows (query, pivot, far): how far each query is from each pivot. A query has no length of its
        own to add, as it is only compared by products."""
        shared, reach = queries.sparkSession.sparkContext.broadcast(self.pivots), self.reach

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, p = (x.astype(np.float64) for x in (_matrix(batch.column(1)), shared.value))
                far = np.sqrt(np.maximum((q * q).sum(1)[:, None] + reach * reach - 2 * q @ p.T, 0.0))
                n, m = far.shape
                columns = np.repeat(np.asarray(batch.column(0)), m), np.tile(np.arange(m, dtype=np.int32), n), far.ravel()
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["query", "pivot", "far"])

        return queries.select("query", "vector").mapInArrow(run, "query bigint, pivot int, far double")


def _score(index: Index, visits: DataFrame, k: int) -> DataFrame:
    """The k best vectors of every block for every query that visits it: (query, query_id, vec_id, score)."""
    key = ["pivot", "annulus", "part"]
    chunk = F.pmod(F.xxhash64("query"), F.greatest(F.lit(1), F.ceil(F.col("visitors") / QUERIES)).cast("int"))
    visitors = staged(visits.groupBy(*key).agg(F.count("*").alias("visitors")), "visitors")
    asked = visits.join(visitors, key).groupBy(*key, chunk.alias("chunk"))
    asked = asked.agg(F.collect_list(F.struct("query", "query_id", "vector")).alias("asked"))
    met = asked.join(index.blocks.select(*key, "rows"), key).select("asked", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked, rows = batch.column(0)[i].values, batch.column(1)[i].values
                query, q, ids = np.asarray(asked.field("query")), np.asarray(asked.field("query_id")), np.asarray(rows.field("vec_id"))
                scores = _product(_matrix(asked.field("vector")), _matrix(rows.field("vector")))
                order = np.argsort(ids, kind="stable")
                ids, scores = ids[order], scores[:, order]
                own = q[:, None] == ids  # rows of the query's id, however many, come last
                best = np.lexsort((np.broadcast_to(np.arange(len(ids)), scores.shape), -scores, own), axis=1)[:, :k]
                told = ~np.take_along_axis(own, best, 1).ravel()
                out = np.repeat(query, best.shape[1]), np.repeat(q, best.shape[1]), ids[best.ravel()], np.take_along_axis(scores, best, 1).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(x[told]) for x in out], ["query", "query_id", "vec_id", "score"])

    return met.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of every query with their ranks, ties to the smaller id."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of every query among vectors of one dimension."""
    index = Index(vectors)
    width, last = index.reach * WIDTH, int(2 / WIDTH) + 1
    asked = staged(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "vector", _square("vector").alias("square")), "queries")
    far = staged(index.distances(asked), "distances")
    best = vectors.sparkSession.createDataFrame([], "query bigint, query_id bigint, vec_id bigint, score bigint, rank int")
    before, radius = -1.0, width
    while True:
        # a query's k-th best so far bounds how far it need look; infinite while there are fewer
        worst = best.groupBy("query").agg(F.min("score").alias("worst"), F.count("*").alias("found"))
        least = F.sqrt(F.greatest(F.lit(0.0), F.col("square") + index.reach**2 - 2.0 * F.col("worst"))) * (1 + 1e-9) + 1e-3
        limit = F.when(F.col("found") >= k, least).otherwise(float("inf"))
        going = asked.join(worst, "query", "left").select("query", "query_id", "vector", limit.alias("limit"))
        going = staged(going.where(F.col("limit") > before), "open-queries")
        if going.isEmpty():
            return best
        cell = lambda r, sign: F.floor((F.col("far") + sign * r) / width + sign * 1e-6).cast("int")
        now = F.least(F.col("limit"), F.lit(radius))
        reached = F.sequence(F.greatest(F.lit(0), F.least(F.lit(last), cell(now, -1))), F.least(F.lit(last), cell(now, 1)))
        seen = lambda a: F.lit(before >= 0) & (a >= cell(F.lit(before), -1)) & (a <= cell(F.lit(before), 1))
        visits = far.join(going, "query").withColumn("annulus", F.explode(F.filter(reached, lambda a: ~seen(a))))
        bound = F.greatest(F.col("far") - F.col("high"), F.col("low") - F.col("far"))
        visits = visits.join(index.blocks.select("pivot", "annulus", "part", "low", "high"), ["pivot", "annulus"])
        visits = visits.where(bound <= F.col("limit")).select("query", "query_id", "vector", "pivot", "annulus", "part")
        visits = staged(visits, "visits")
        best = staged(_top(best.drop("rank").union(_score(index, visits, k)), k), "best")
        if radius > 2 * index.reach + 2 * width:
            return best
        before, radius = radius, 2 * radius


def _square(vector: str) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "vector") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every vector that ``is_query`` holds for (an expression of
    vec_id), the k others of highest integer inner product; all, if there are fewer. Ties go to the smaller id.

    Vectors are arrays of integers. Rows with a null id, vector or component take no part. Rows alike in id and vector count once;
    unlike vectors of one id are rows of their own, as candidates and as queries, and none is a candidate of its id's queries. Vectors of
    different dimensions do not meet. Repeated vectors under other ids are vectors like any other. An empty table gives no rows.
    """
    given = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<bigint>").alias("vector"))
    given = given.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    given = staged(given.distinct().withColumn("row", F.xxhash64("vec_id", "vector")), "vectors")
    sizes = [r[0] for r in given.select(F.size("vector").alias("d")).distinct().orderBy("d").collect()]  # an index for each
    found = [given.sparkSession.createDataFrame([], "query bigint, query_id bigint, vec_id bigint, score bigint, rank int")]
    for size in sizes:
        some = given.where(F.size("vector") == size)
        found.append(_search(some, some.where(is_query), k))
    return reduce(DataFrame.union, found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
