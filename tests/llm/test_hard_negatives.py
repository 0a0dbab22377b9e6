import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, queries


def brute_force(rows, anchor, positives=5, negatives=5, least=80, most=100):
    """All products; rows are (id, label, vector)."""
    rows = sorted({(i, x, tuple(v)) for i, x, v in rows if None not in (i, x, v) and None not in v})
    out = []
    for i, label, v in rows:
        if not anchor(i):
            continue
        scored = sorted((-int(np.dot(v, w)), j, other) for j, other, w in rows if j != i and len(w) == len(v))
        liked = [(-s, j) for s, j, other in scored if other == label][:positives]
        for score, p in liked:
            good = [(-s, j) for s, j, other in scored if other != label and least * score <= -100 * s <= most * score]
            out += [(i, p, r, j, score, s) for r, (s, j) in enumerate(good[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=3, **options):
    df = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], "vec_id bigint, label int, vector array<bigint>, row int, bucket string, score double")
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % every == 0, **options).collect())


def drawn(n, size, seed, labels=3, spread=(1, 1, 5, 40)):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, size)) * 20
    out = []
    for i in range(n):
        v = (centres[draw.integers(4)] + draw.normal(size=size) * 8) * spread[draw.integers(4)]
        out.append((i, int(draw.integers(labels)), [int(x) for x in v]))
    return out


@pytest.mark.parametrize("bucket,focus", [(2048, 6), (8, 2), (3, 1)])
def test_against_all_products(spark, monkeypatch, bucket, focus):
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    monkeypatch.setattr(hard_negatives, "CHUNK", 4)
    rows = drawn(240, 6, 3) + [(i + 300, label, v) for i, label, v in drawn(60, 3, 4)]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 3 == 0)


def test_odd_rows(spark):
    rows = [
        (0, 1, [1, 2]), (3, 1, [1, 2]), (3, 1, [1, 2]), (3, 1, [4, -4]), (6, None, [1, 1]), (None, 1, [1, 1]), (9, 1, None), (12, 1, [1, None]),
        (15, 1, [0, 0]), (18, 2, [0, 0]), (21, 2, [1, 2]), (24, 2, [1, 2]), (25, 2, []), (27, 1, []), (28, 1, []), (30, 3, [-5, -9]), (33, 3, [5, 9]),
        (36, 2, [3]), (39, 2, [2**25, 2**25]), (42, 1, [2**25, 2**25 - 1]), (45, 1, [2**26, 2**26]),
    ]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 3 == 0)
    assert mined(spark, rows, every=1, positives=2, negatives=3, least=50, most=90) == brute_force(rows, lambda i: True, 2, 3, 50, 90)
    assert mined(spark, []) == []


def test_hot_label_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 16)
    rows = [(i, 1 if i % 3 else 2, [i % 4, 3]) for i in range(300)] * 2
    assert mined(spark, rows, every=50) == brute_force(rows, lambda i: i % 50 == 0)


def test_pruning_keeps_every_candidate_and_drops_others():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 32)) ** 5 * 30  # a few coordinates are large
    vectors = centres[np.arange(2000) % 20] + draw.normal(size=(2000, 32)) * 10
    vectors = (vectors * 1000 / np.sqrt((vectors**2).sum(1))[:, None]).astype(np.int64)  # as in a bucket: alike in length
    lists, longest = hard_negatives.sorted_lists(vectors), float(np.sqrt((vectors**2).sum(1)).max())
    anchors = vectors[:20]
    scores = hard_negatives.products(anchors, vectors)
    least = np.sort(scores, axis=1)[:, -10].astype(float)
    may = hard_negatives.candidates(anchors, least, vectors, lists, longest)
    assert may[scores >= least[:, None]].all() and may.mean() < 0.3
    assert not hard_negatives.candidates(anchors, np.full(20, longest**2 * 2), vectors, lists, longest).any()


def test_the_query_on_all_embeddings(spark, sf):
    rows = []
    for i, label, v in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect():
        rows.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]))
    got = queries.op11_hard_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, lambda i: i % 100 == 0)


def test_copies_of_the_anchors_are_not_broadcast(spark):
    """Fails where the copies for all cells count as one copy when joins are chosen."""
    got = hard_negatives.mine(spark.createDataFrame(drawn(300, 6, 5), "vec_id bigint, label int, vector array<bigint>"), F.col("vec_id") % 3 == 0)
    assert got.count() > 0 and len(got.collect()) > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [cell#" in plan and "BroadcastHashJoin [cell#" not in plan
