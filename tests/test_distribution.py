import numpy as np
import pytest

from tidemark.operators import distribution as d


def scores(spark, n=500):
    rng = np.random.default_rng(2)
    rows = [(float(np.round(x, 4)), int(x + rng.normal(0, 0.3) > 0.5)) for x in rng.random(n)]
    return rows, spark.createDataFrame(rows, "p double, y int")


def test_summary(spark):
    rows, df = scores(spark)
    p = np.array([r[0] for r in rows])
    got = d.score_summary(df, "p").first()
    assert got.mean == pytest.approx(p.mean()) and got["std"] == pytest.approx(p.std())
    assert got.median == pytest.approx(np.median(p)) and (got["min"], got["max"]) == (p.min(), p.max())


def test_risk_summary_of_nothing_is_zero(spark):
    row = d.risk_summary(spark.createDataFrame([], "p double"), "p", 0.5).first()
    assert (row.total, row.n_high_risk, row.high_risk_pct) == (0, 0, 0.0)


@pytest.mark.parametrize("bounds", [(0.0, 1.0), None])
def test_histogram_counts_every_row_and_keeps_empty_bins(spark, bounds):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.5,), (1.0,), (1.0,), (None,)], "p double")
    rows = d.histogram(df, "p", 10, bounds).orderBy("bin").collect()
    assert [r.n for r in rows] == [2, 0, 0, 0, 0, 1, 0, 0, 0, 2]
    assert rows[0].bin_start == 0.0 and rows[-1].bin_end == pytest.approx(1.0)


def test_histogram_leaves_out_values_beyond_the_bounds(spark):
    df = spark.createDataFrame([(-0.1,), (0.5,), (1.1,)], "p double")
    assert sum(r.n for r in d.histogram(df, "p", 10).collect()) == 1


def test_histogram_by_class(spark):
    rows, df = scores(spark)
    got = d.histogram(df, "p", 20, by="y").collect()
    assert len(got) == 40
    for y in (0, 1):
        assert sum(r.n for r in got if r.y == y) == sum(1 for r in rows if r[1] == y)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "p double")
    assert sum(r.n for r in d.histogram(df, "p", 5, None).collect()) == 2


def test_five_numbers(spark):
    rows, df = scores(spark)
    for r in d.five_numbers(df, "p", ["y"]).collect():
        p = [a for a, b in rows if b == r.y]
        assert [r["min"], r.q1, r["median"], r.q3, r["max"]] == pytest.approx(np.quantile(p, [0, 0.25, 0.5, 0.75, 1]))


def test_bands_exclude_zero_and_include_one(spark):
    df = spark.createDataFrame([(0.0, 0), (0.2, 0), (0.21, 1), (1.0, 1)], "p double, y int")
    got = {r.band: (r.stayed, r.left) for r in d.score_band_outcomes(df, "p", "y").collect()}
    assert got == {"(0.0, 0.2]": (1, 0), "(0.2, 0.4]": (0, 1), "(0.8, 1.0]": (0, 1)}


def test_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, float("nan"), None), (None, 3.0, "b")], "i int, x double, s string")
    rows = {r.column_name: r for r in d.column_profile(df).collect()}
    assert [rows[c].n_missing for c in "ixs"] == [1, 1, 1]
    assert (rows["x"].min_value, rows["x"].max_value) == (2.0, 3.0) and rows["s"].min_value is None
    assert rows["i"].data_type == "int"


def test_display(spark):
    df = spark.createDataFrame([("b", 0.12345, False), ("a", 0.9, True)], "id string, p double, f boolean")
    rows = d.display_rows(df, "p", "f", "id", 1).collect()
    assert [tuple(r) for r in rows] == [("a", "0.900", "Yes")]
