import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import classification as c
from tidemark.operators import curves

Y = [0, 0, 1, 1, 0, 1]
P = [0, 1, 1, 1, 0, 0]


def table(spark, y, p, score=None):
    score = score or [float(x) for x in p]
    return spark.createDataFrame(list(zip(y, p, score)), "y int, p int, s double")


def test_confusion_matrix(spark):
    counts = c.confusion_counts(table(spark, Y, P), "y", "p")
    assert c.with_matrix(counts).first().confusion_matrix == [[2, 1], [1, 2]]


def test_one_class_still_gives_four_counts(spark):
    row = c.with_metrics(c.confusion_counts(table(spark, [0, 0], [0, 0]), "y", "p")).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (2, 0, 0, 0)
    assert (row.precision, row.recall, row.f1_score, row.accuracy) == (0, 0, 0, 1)


def test_metrics(spark):
    row = c.with_metrics(c.confusion_counts(table(spark, Y, P), "y", "p")).first()
    assert row.precision == row.recall == row.f1_score == row.accuracy == pytest.approx(2 / 3)
    rates = c.with_rates(c.confusion_counts(table(spark, Y, P), "y", "p")).first()
    assert rates.tpr + rates.fnr == 1 and rates.tnr + rates.fpr == 1


def test_matthews_and_kappa(spark):
    y = [1] * 6 + [0] * 4
    p = [1, 1, 1, 1, 0, 0, 0, 0, 0, 1]
    counts = c.confusion_counts(table(spark, y, p), "y", "p")
    row = c.with_kappa(c.with_matthews(counts)).first()
    assert row.matthews == pytest.approx((4 * 3 - 1 * 2) / np.sqrt(5 * 6 * 4 * 5))
    assert row.kappa == pytest.approx((0.7 - 0.5) / 0.5)
    empty = c.with_matthews(c.confusion_counts(table(spark, [0], [0]), "y", "p")).first()
    assert empty.matthews == 0


def test_classification_report(spark):
    rows = {r.label: r for r in c.classification_report(c.confusion_counts(table(spark, Y, P), "y", "p")).collect()}
    assert list(rows) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert rows["0"].precision == pytest.approx(2 / 3) and rows["1"].support == 3
    assert rows["weighted avg"].support == 6


def brute_auc(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("decimals", [1, 6])
def test_auc_equals_pair_counting(spark, decimals):
    rng = np.random.default_rng(decimals)
    y = rng.integers(0, 2, 300).tolist()
    s = np.round(rng.random(300), decimals).tolist()
    assert c.roc_auc(table(spark, y, y, s), "y", "s").first().roc_auc == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_auc_of_one_class_is_zero(spark):
    assert c.roc_auc(table(spark, [1, 1], [1, 1], [0.2, 0.4]), "y", "s").first().roc_auc == 0.0


def test_evaluation_equals_its_parts(spark):
    rng = np.random.default_rng(5)
    rows = [(int(a), float(np.round(b, 2)), "v1" if k < 100 else "v2") for k, (a, b) in enumerate(zip(rng.integers(0, 2, 300), rng.random(300)))]
    df = spark.createDataFrame(rows, "y int, s double, model_version string").withColumn("p", (F.col("s") >= 0.5).cast("int"))
    whole = {r.model_version: r for r in c.evaluate(df, "y", "s", "p").collect()}
    for version in ("v1", "v2"):
        part = df.where(F.col("model_version") == version)
        counts = c.with_metrics(c.confusion_counts(part, "y", "p")).first()
        assert all(whole[version][k] == counts[k] for k in ("tn", "fp", "fn", "tp", "precision", "recall", "n_samples"))
        assert whole[version].roc_auc == pytest.approx(c.roc_auc(part, "y", "s").first().roc_auc)


def test_unset_version_is_unknown(spark):
    df = table(spark, Y, P).withColumn("model_version", F.lit(None).cast("string"))
    row = c.evaluation_rows(df, "y", "s", "p", F.lit("2024-01-01")).first()
    assert row.model_version == "unknown" and row.n_samples == 6


def test_positive_weight(spark):
    row = c.positive_weight(table(spark, [0, 0, 0, 1], [0] * 4), "y").first()
    assert row.scale_pos_weight == pytest.approx(22.5)
    assert c.positive_weight(table(spark, [0], [0]), "y").first().scale_pos_weight is None


def test_trend(spark):
    rows = [(0.9, dt.date(2024, 1, 1)), (0.8, dt.date(2024, 1, 2)), (0.7, dt.date(2024, 1, 3))]
    t = c.trend_summary(spark.createDataFrame(rows, "recall double, evaluation_date date")).first()
    assert t.recall_drop == pytest.approx(0.2) and t.first_breach == dt.date(2024, 1, 2)


def test_roc_curve_points(spark):
    y, s = [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]
    points = curves.roc_curve(table(spark, y, y, s), "y", "s").orderBy("tpr", "fpr").collect()
    assert [(r.threshold, r.fpr, r.tpr) for r in points] == [
        (None, 0.0, 0.0), (0.8, 0.0, 0.5), (0.4, 0.5, 0.5), (0.35, 0.5, 1.0), (0.1, 1.0, 1.0),
    ]


def test_cdf(spark):
    df = table(spark, [0] * 4, [0] * 4, [0.1, 0.1, 0.2, 0.3])
    got = {r.s: r.cumulative_share for r in curves.empirical_cdf(df, "s").collect()}
    assert got == {0.1: 0.5, 0.2: 0.75, 0.3: 1.0}


CAL_Y = [0, 0, 1, 1, 0, 1, 1, 0, 1, 0]
CAL_P = [0.1, 0.2, 0.7, 0.8, 0.3, 0.9, 0.6, 0.15, 0.85, 0.25]


@pytest.mark.parametrize("strategy", ["uniform", "quantile"])
def test_calibration_matches_numpy(spark, strategy):
    rows = curves.calibration_curve(table(spark, CAL_Y, CAL_Y, CAL_P), "y", "s", 5, strategy).orderBy("bin").collect()
    y, p = np.array(CAL_Y), np.array(CAL_P)
    edges = np.linspace(0, 1, 6) if strategy == "uniform" else np.percentile(p, np.linspace(0, 100, 6))
    bins = np.searchsorted(edges[1:-1], p)
    assert [r.bin for r in rows] == sorted(set(bins.tolist()))
    for r in rows:
        assert r.prob_true == pytest.approx(y[bins == r.bin].mean()) and r.prob_pred == pytest.approx(p[bins == r.bin].mean())
    assert sum(r.n for r in rows) == 10


def test_calibration_arguments(spark):
    df = table(spark, CAL_Y, CAL_Y, CAL_P)
    with pytest.raises(ValueError, match="n_bins must be at least 2"):
        curves.calibration_curve(df, "y", "s", 1)
    with pytest.raises(ValueError, match="strategy"):
        curves.calibration_curve(df, "y", "s", 5, "other")


def test_calibration_quality(spark):
    df = spark.createDataFrame([(0.01,), (0.05,), (0.2,)], "e double")
    got = [r.q for r in df.select(curves.calibration_quality(F.col("e")).alias("q")).collect()]
    assert got == ["well calibrated", "acceptable", "poor"]


def test_rows_without_a_score_count_by_their_class(spark):
    rows = [("a", 1, 0.9, 1), ("a", 0, None, 1), ("a", 1, float("nan"), 0), ("a", 0, 0.2, 0), ("b", 1, None, 1)]
    df = spark.createDataFrame(rows, "model_version string, y int, p double, c int")
    a, b = c.evaluate(df, "y", "p", "c").orderBy("model_version").collect()
    assert (a.tn, a.fp, a.fn, a.tp, a.n_samples, a.n_unscored, a.roc_auc) == (1, 1, 1, 1, 4, 2, 1.0)
    assert (b.tp, b.n_samples, b.n_unscored, b.roc_auc, b.recall) == (1, 1, 1, 0.0, 1.0)


def test_evaluation_reads_its_table_once(spark, tmp_path):
    rows = [(i % 2, float(i % 5) if i % 7 else None, i % 3 % 2, "v") for i in range(60)]
    spark.createDataFrame(rows, "y int, s double, p int, model_version string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert c.evaluate(df, "y", "s", "p").first().n_unscored == 9
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shows reused exchanges before the run
    try:
        plan = c.evaluate(df, "y", "s", "p")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 1, plan


def test_evaluation_of_score_counts_in_parts(spark):
    rows = [(i % 2, float(i % 5) if i % 7 else float("nan"), i % 3 % 2, "v" if i % 4 else "w") for i in range(60)]
    df = spark.createDataFrame(rows, "y int, s double, p int, model_version string")
    half = [c.score_counts(df.where(x), "y", "s", "p", ["model_version"]) for x in ("p = 0", "p = 1")]
    parts = c.evaluate_score_counts(half[0].unionByName(half[1]))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, c.evaluate(df, "y", "s", "p").collect()))
