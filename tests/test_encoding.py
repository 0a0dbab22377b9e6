import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tidemark.operators import encoding, sampling


def matrix(encoder, df):
    rows = encoder.transform(df).select(vector_to_array("features").alias("v")).collect()
    return np.array([r.v for r in rows])


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(25, 50000.0), (30, 60000.0), (35, 70000.0), (40, 80000.0)], "age int, income double")
    m = matrix(encoding.fit_encoder(df, ["age", "income"], []), df)
    assert m.shape == (4, 2)
    assert np.allclose(m.mean(axis=0), 0) and np.allclose(m.std(axis=0), 1)


def test_gaps_are_filled_before_scaling(spark):
    df = spark.createDataFrame([(25.0,), (30.0,), (None,), (40.0,), (float("nan"),)], "age double")
    encoder = encoding.fit_encoder(df, ["age"], [])
    filled = np.array([25.0, 30.0, 95 / 3, 40.0, 95 / 3])
    assert encoder.means["age"] == pytest.approx(95 / 3)
    assert encoder.scales["age"] == pytest.approx(filled.std())
    m = matrix(encoder, df)
    assert not np.isnan(m).any() and m[2, 0] == pytest.approx(0)


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    encoder = encoding.fit_encoder(df, ["x"], [])
    assert encoder.scales["x"] == 1.0 and (matrix(encoder, df) == 0).all()


def test_categories_are_sorted_and_unseen_ones_encode_to_zeros(spark):
    train = spark.createDataFrame([("B",), ("A",), ("C",), ("A",), (None,)], "category string")
    encoder = encoding.fit_encoder(train, [], ["category"])
    assert encoder.feature_names == ["category_A", "category_B", "category_C"]
    other = spark.createDataFrame([("C",), ("Z",), (None,)], "category string")
    assert matrix(encoder, other).tolist() == [[0, 0, 1], [0, 0, 0], [1, 0, 0]]


def test_columns_with_different_numbers_of_categories(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), ("c", "it's", 3.0)], "p string, q string, n double")
    encoder = encoding.fit_encoder(df, ["n"], ["p", "q"])
    assert encoder.feature_names == ["n", "p_a", "p_b", "p_c", "q_it's", "q_x"]
    assert matrix(encoder, df)[:, 1:].tolist() == [[1, 0, 0, 0, 1], [0, 1, 0, 0, 1], [0, 0, 1, 1, 0]]


def test_most_frequent_category_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "c string")
    assert encoding.category_modes(encoding.category_counts(df, ["c"])).first()["mode"] == "a"
    assert encoding.fit_encoder(df, [], ["c"]).modes == {"c": "a"}


def test_saved_encoder_gives_the_same_output(spark, tmp_path):
    df = spark.createDataFrame([(25.0, "A"), (30.0, "B"), (35.0, "A")], "age double, category string")
    encoder = encoding.fit_encoder(df, ["age"], ["category"])
    encoder.save(spark, str(tmp_path / "enc"))
    loaded = encoding.FittedEncoder.load(spark, str(tmp_path / "enc"))
    assert loaded == encoder and (matrix(loaded, df) == matrix(encoder, df)).all()


def test_nothing_to_encode_gives_width_zero(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert encoding.fit_encoder(df, [], []).transform(df).first().features == []


def test_applying_an_encoder_shuffles_nothing(spark):
    df = spark.createDataFrame([(25.0, "A"), (30.0, "B")], "age double, category string")
    plan = encoding.fit_encoder(df, ["age"], ["category"]).transform(df)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def labelled(spark, n=5000):
    return spark.range(n).selectExpr("concat('C', id) customer_id", "int(id % 10 < 3) churn")


def test_stratified_split_is_exact_per_class(spark):
    df = sampling.stratified_split(labelled(spark), "churn")
    counts = {(r.churn, r.is_test): r["count"] for r in df.groupBy("churn", "is_test").count().collect()}
    assert counts == {(0, True): 700, (0, False): 2800, (1, True): 300, (1, False): 1200}


def test_stratified_split_does_not_depend_on_partitioning(spark):
    pick = lambda d: {r.customer_id for r in sampling.stratified_split(d, "churn").where("is_test").collect()}
    assert pick(labelled(spark)) == pick(labelled(spark).repartition(7))


def test_stratified_split_keeps_a_repeated_key_together_and_unlabelled_rows_out(spark):
    hot = spark.range(3000).selectExpr("'HOT' customer_id", "1 churn")
    none = spark.range(10).selectExpr("concat('N', id) customer_id", "cast(null as int) churn")
    df = sampling.stratified_split(labelled(spark).union(hot).union(none), "churn")
    assert df.count() == 8010
    assert df.where("customer_id = 'HOT'").select("is_test").distinct().count() == 1
    assert df.where("churn is null and is_test").isEmpty()


def test_stratified_split_does_not_shuffle_the_table(spark):
    df = sampling.stratified_split(labelled(spark).selectExpr("*", "1 wide"), "churn")
    plan = df._jdf.queryExecution().executedPlan().toString()
    outer = plan[: plan.index("Subquery")]
    assert "Exchange" not in outer and "Join" not in outer


def test_samples(spark):
    df = labelled(spark)
    first = {r.customer_id for r in sampling.sample_rows(df, 100).collect()}
    assert len(first) == 100 == len({r.customer_id for r in sampling.sample_rows(df.repartition(3), 100).collect()} & first)
    assert sampling.sample_rows(df.limit(40), 100).count() == 40
    assert [r.customer_id for r in sampling.first_rows(df, 2).collect()] == ["C0", "C1"]
    share = sampling.split_by_hash(df).where("is_test").count() / 5000
    assert abs(share - 0.2) < 0.03


def test_fitting_reads_its_table_once_and_refuses_too_many_categories(spark, tmp_path):
    rows = [(i, float(i % 7) if i % 5 else None, float("nan") if i % 3 else 2.0, "abc"[i % 3] if i % 4 else None, f"id{i}") for i in range(50)]
    spark.createDataFrame(rows, "i int, x double, y double, c string, d string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = encoding.fitted_counts(df, ["x", "y"], ["c", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    encoder = encoding.fit_encoder(df, ["x", "y"], ["c"])
    stats = {r.feature: (r["mean"], r["scale"]) for r in encoding.numeric_stats(df, ["x", "y"]).collect()}
    for c in ("x", "y"):
        assert (encoder.means[c], encoder.scales[c]) == pytest.approx(stats[c])
    assert encoder.categories == {"c": ["a", "b", "c"]}
    modes = {r.feature: r["mode"] for r in encoding.category_modes(encoding.category_counts(df, ["c"])).collect()}
    assert encoder.modes == modes
    assert len(encoding.fit_encoder(df, ["x"], ["c", "d"], most_categories=50).categories["d"]) == 50
    for most in (49, 2):
        with pytest.raises(ValueError, match="one-hot"):
            encoding.fit_encoder(df, ["x"], ["c", "d"], most_categories=most)
    empty = encoding.fit_encoder(df.limit(0), ["x"], ["c"])
    assert empty.means == {"x": 0.0} and empty.scales == {"x": 1.0} and empty.categories == {}
