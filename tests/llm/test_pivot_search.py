import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pivot_search, queries


def brute_force(rows, is_query, k):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.int64)
    out = []
    for i, v in rows:
        if is_query(i):
            scores = (matrix @ np.array(v, np.int64)).tolist()
            best = sorted((-s, j) for s, j in zip(scores, ids.tolist(), strict=True) if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def test_ties_repeats_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK", 32)
    monkeypatch.setattr(pivot_search, "QUERIES", 8)
    draw = random.Random(2)
    rows = [(i, [draw.randint(-3, 3) * draw.choice([1, 1000]) for _ in range(3)]) for i in range(200)]
    rows += [(i, [5, 5, 5]) for i in range(200, 290)] + [(i, [0, 0, 0]) for i in range(290, 300)] + [(-7, [1, 1, 1])]
    more = [(None, [1, 2, 3]), (1000, None), (1001, [1, None, 2]), rows[1], rows[7]]
    given = [(i, v, 1, 1) for i, v in rows + more]
    table = spark.createDataFrame(given, "vec_id bigint, vector array<bigint>, rank int, score int")
    got = pivot_search.nearest(table, F.col("vec_id") % 7 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, lambda i: i % 7 == 0, 4)


def test_unlike_vectors_of_one_id_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK", 16)
    draw = random.Random(6)
    rows = sorted({(draw.randrange(20), tuple(draw.randint(-9, 9) for _ in range(2))) for _ in range(150)})
    rows += [(0, (9, i)) for i in range(20, 60)]  # one id holds more than k of the best
    table = spark.createDataFrame([(i, list(v)) for i, v in rows + rows[:30]], "vec_id bigint, vector array<bigint>")
    got = pivot_search.nearest(table, F.col("vec_id") % 5 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, lambda i: i % 5 == 0, 3)


def test_few_vectors_dimensions_and_large_numbers(spark):
    big = 3_000_000_000
    rows = [(0, [big, big]), (7, [big, -big + 1]), (14, [1]), (15, [2]), (21, []), (22, []), (28, [1, 2, 3])]
    table = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    got = sorted(map(tuple, pivot_search.nearest(table, F.col("vec_id") % 7 == 0).collect()))
    assert got == [(0, 1, 7, big), (7, 1, 0, big), (14, 1, 15, 2), (21, 1, 22, 0)]
    assert pivot_search.nearest(table.limit(0), F.lit(True)).count() == 0


def test_unusable_components(spark):
    rows = [(1, [0.5, float("nan")]), (2, [float("inf"), 0.0]), (3, [None, 1.0]), (4, None), (5, [-0.0001, 0.5]), (6, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").where(pivot_search.usable("embedding"))
    got = table.select("vec_id", pivot_search.scaled("embedding", 1024)).collect()
    assert [tuple(r) for r in got] == [(5, [-1, 512]), (6, [])]


def test_the_query_on_all_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r[0], [math.floor(1024 * float(x)) for x in r[1]]) for r in rows]
    got = sorted(map(tuple, queries.op1_pivot_search(spark, sf).collect()))
    assert got == brute_force(rows, lambda i: i % 100 == 0, 10)


def test_pruning_visits_part_of_clustered_vectors(spark, monkeypatch):
    """Far clusters are excluded by the bounds, not by chance: few block visits, same result."""
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 3000, (12, 8))
    rows = [(i, np.floor(centres[i % 12] + draw.normal(0, 10, 8)).astype(int).tolist()) for i in range(1200)]
    monkeypatch.setattr(pivot_search, "BLOCK", 50)
    seen = []
    score = pivot_search._score
    monkeypatch.setattr(pivot_search, "_score", lambda index, visits, k: seen.append((visits.count(), index.blocks.count())) or score(index, visits, k))
    table = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    got = sorted(map(tuple, pivot_search.nearest(table, F.col("vec_id") % 100 == 0).collect()))
    assert got == brute_force(rows, lambda i: i % 100 == 0, 10)
    assert sum(v for v, _ in seen) < 12 * seen[0][1]
