import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import key_uniform, right_closed_bin
from tidemark.functions.ranks import exact_quantiles, running_totals

PROBS = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "p90": 0.9, "hi": 1.0}


def skewed(n=4000, seed=0):
    """A third of the rows share one value; the rest spans many magnitudes."""
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(n) < 1 / 3, 0.5, np.exp(rng.normal(0, 4, n)))
    return pd.DataFrame({"g": rng.choice(["a", "b", None], n, p=[0.8, 0.15, 0.05]), "v": values})


@pytest.mark.parametrize("buckets", [8, 9, 64])
def test_quantiles_match_numpy(spark, buckets):
    pdf = skewed()
    got = exact_quantiles(spark.createDataFrame(pdf), "v", PROBS, buckets=buckets).first()
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(pdf.v, p), rel=1e-12)


def test_quantiles_per_group_with_null_group(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf.astype({"g": object}).where(pdf.notna(), None))
    got = {r.g: r for r in exact_quantiles(df, "v", PROBS, ["g"]).collect()}
    assert set(got) == {"a", "b", None}
    for g, part in pdf.groupby("g", dropna=False):
        row = got[g if isinstance(g, str) else None]
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(part.v, p), rel=1e-12)


def test_missing_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first().m == 2.0


def test_empty_table_has_no_quantiles(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first().m is None


def test_running_totals_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(skewed(1500, 3)).withColumn("y", (F.rand(1) < 0.4).cast("int")).persist()

    def totals(d, buckets):
        rows = running_totals(d, "v", {"n": F.count(F.lit(1)), "pos": F.sum("y")}, buckets=buckets)
        return sorted(map(tuple, rows.collect()))

    one = totals(df.coalesce(1), 8)
    assert one == totals(df.repartition(7), 50)
    pdf = df.toPandas().groupby("v").agg(n=("y", "size"), pos=("y", "sum")).sort_index()
    assert [r[3] for r in one] == list(pdf.n.cumsum().shift(fill_value=0))
    assert [r[4] for r in one] == list(pdf.pos.cumsum().shift(fill_value=0))
    df.unpersist()


def test_running_totals_plan_has_no_global_sort_of_rows(spark):
    """The only window without a group runs over bucket totals."""
    df = spark.range(1000).select((F.col("id") / 7).alias("v"))
    plan = running_totals(df, "v", {"n": F.count(F.lit(1))})._jdf.queryExecution().executedPlan().toString()
    final_window = plan.index("Window [sum(n")
    assert "__key" in plan[final_window : final_window + 300]


def test_key_uniform_is_uniform_and_stable(spark):
    df = spark.range(20000).select("id", key_uniform("id", 42).alias("u"))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert stats[0] >= 0 and stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
    again = df.repartition(5).withColumnRenamed("u", "w").join(df, "id").where(F.col("u") != F.col("w"))
    assert again.isEmpty()


def test_bins_are_closed_on_the_right(spark):
    edges = [i * (1.0 / 5) for i in range(1, 5)]
    df = spark.createDataFrame([(0.0,), (0.2,), (0.2000001,), (0.6,), (1.0,)], "p double")
    got = [r.b for r in df.select(right_closed_bin(F.col("p"), edges).alias("b")).collect()]
    assert got == [int(np.searchsorted(edges, p, side="left")) for p in (0.0, 0.2, 0.2000001, 0.6, 1.0)]


def test_quantiles_of_many_values_have_the_right_rank(spark):
    """Far more distinct values than a sketch keeps, so the edges are approximate."""
    df = spark.range(400_000).select((F.xxhash64("id") / F.lit(2.0**40)).alias("v"), (F.col("id") % 2).alias("g"))
    ps = {"a": 0.1, "b": 0.5, "c": 0.999}
    for r in exact_quantiles(df.repartition(6), "v", ps, ["g"]).collect():
        part = df.where(F.col("g") == r.g)
        for name, p in ps.items():
            position = p * 199_999
            below = part.where(F.col("v") <= r[name]).count()
            assert below == int(position) + 1


def test_the_ends_of_the_hash_range(spark):
    from tidemark.functions.columns import hash_below

    ids = spark.range(2000).withColumn("id", F.col("id").cast("string"))
    share = lambda f: ids.where(hash_below("id", 1, f)).count()
    assert share(0.0) == 0 and share(1.0) == 2000 and 850 < share(0.5) < 1150
    with pytest.raises(ValueError, match="between 0 and 1"):
        hash_below("id", 1, 1.5)


def test_outer_values_are_cut_into_widths_too(spark):
    df = spark.range(50_000).select((F.col("id") * 1.0).alias("v"))
    row = exact_quantiles(df, "v", {"lo": 0.0, "near": 0.001, "hi": 1.0}).first()
    assert (row.lo, row.hi) == (0.0, 49_999.0) and abs(row.near - 49.999) < 1e-9


def test_quantiles_of_many_unlike_groups(spark):
    """Groups of different sizes and scales; what is ranked is a small multiple of the groups."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 4000 != 3, F.col("id") % 4000).alias("g"),
        (F.pow(F.lit(1.7), (F.col("id") % 40).cast("double")) * (F.xxhash64("id") % 1000)).alias("x"),
    ).union(spark.range(40_000).select(F.lit(7).cast("bigint").alias("g"), (F.xxhash64("id") % 100_000).cast("double").alias("x")))
    got = exact_quantiles(rows, "x", {"q1": 0.25, "median": 0.5, "top": 0.97}, ["g"])
    expected = rows.groupBy("g").agg(*[F.percentile("x", p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("top", 0.97))])
    a = {r[0]: tuple(r)[1:] for r in got.collect()}
    b = {r[0]: tuple(r)[1:] for r in expected.collect()}
    assert a.keys() == b.keys() and len(a) == 4000 and None in a
    for key, values in a.items():
        assert values == pytest.approx(b[key], rel=1e-12)
