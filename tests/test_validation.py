import pytest
from pyspark.sql import functions as F

from tidemark.errors import TableCheckError
from tidemark.operators import validation as v

SPEC = v.TableSpec(["age", "income", "category"], ["age", "income"], ["category"], "label", {"age": (0, 120)})
ROWS = [(25, 50000, "A"), (30, 60000, "B"), (35, 70000, "C")]
SCHEMA = "age int, income int, category string"


def test_valid_table_passes(spark):
    assert v.check_table(spark.createDataFrame(ROWS, SCHEMA), SPEC)


def test_extra_columns_are_tolerated(spark):
    assert v.check_table(spark.createDataFrame(ROWS, SCHEMA).withColumn("x", F.lit(1)), SPEC)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda df: df.drop("category", "age"), r"Missing required features: \['age', 'category'\]"),
        (lambda df: df.limit(0), "Data is empty"),
        (lambda df: df.withColumn("age", F.lit("old")), "'age' must be numeric"),
        (lambda df: df.withColumn("category", F.lit(1)), "'category' must be categorical"),
        (lambda df: df.withColumn("age", F.col("age") + 100), r"'age' has values outside valid range \[0, 120\]"),
    ],
)
def test_problems_are_named(spark, change, message):
    with pytest.raises(TableCheckError, match=message):
        v.check_table(change(spark.createDataFrame(ROWS, SCHEMA)), SPEC)


def test_training_needs_the_target(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(TableCheckError, match="Missing target variable: label"):
        v.check_table(df, SPEC, training=True)
    no_target = v.TableSpec(SPEC.required, SPEC.numeric, SPEC.categorical)
    with pytest.raises(TableCheckError, match="not specified"):
        v.check_table(df, no_target, training=True)
    assert v.check_table(df.withColumn("label", F.lit(1)), SPEC, training=True)


def test_ranges_ignore_missing_values_and_include_their_ends(spark):
    df = spark.createDataFrame([(0.0,), (120.0,), (None,), (float("nan"),)], "age double")
    report = v.range_report(df, {"age": (0, 120)}).first()
    assert (report.n_outside, report.in_range, report.observed_max) == (0, True, 120.0)
    all_missing = v.range_report(df.where("age is null"), {"age": (0, 1)}).first()
    assert all_missing.in_range and all_missing.observed_min is None


def test_range_violations_name_the_columns(spark):
    df = spark.createDataFrame([(1, -5.0, 200.0), (2, 5.0, 5.0)], "id int, a double, b double")
    rows = v.range_violations(df, {"a": (0, 10), "b": (0, 10)}).collect()
    assert [(r.id, r.out_of_range) for r in rows] == [(1, ["a", "b"])]


def test_records_need_an_id_and_one_known_value(spark):
    rows = [("c1", 1.0, None), ("  ", 1.0, None), (None, float("nan"), None), ("c2", None, "x")]
    df = v.record_problems(spark.createDataFrame(rows, "customer_id string, a double, b string"), ["a", "b"])
    assert [len(r.problems) for r in df.collect()] == [0, 1, 2, 0]
    good, bad = v.split_on_problems(df)
    assert good.count() == 2 and bad.count() == 2
    with pytest.raises(TableCheckError, match="non-empty string"):
        v.raise_on_problems(df)


def test_map_records_report_missing_features(spark):
    rows = [("c1", {"a": "1", "b": None}), ("c2", {"a": "1"}), ("c3", {}), ("c4", {"a": None, "b": "NaN"})]
    df = v.map_record_problems(spark.createDataFrame(rows, "customer_id string, features map<string,string>"), ["a", "b"])
    problems = {r.customer_id: r.problems for r in df.collect()}
    assert problems["c1"] == []
    assert problems["c2"] == ["Missing required features: b"]
    assert problems["c3"] == ["features must be a non-empty dictionary"]
    assert problems["c4"] == ["All feature values cannot be None/NaN"]


def test_log_rows_are_checked_against_their_domain(spark):
    rows = [(0.0, 0, None), (1.0, 1, 1), (1.5, 0, None), (0.5, 2, 0), (0.5, 1, 3), (None, 1, 1)]
    df = v.log_row_problems(spark.createDataFrame(rows, "prediction double, predicted_class int, actual_outcome int"))
    assert [len(r.problems) for r in df.collect()] == [0, 0, 1, 1, 1, 1]


def test_batch_limit_is_optional(spark):
    v.check_max_rows(spark.range(2000), None)
    v.check_max_rows(spark.range(10), 10)
    with pytest.raises(ValueError, match="exceeds maximum 10"):
        v.check_max_rows(spark.range(11), 10)


def test_pairing_counts_each_side(spark):
    a, b = spark.range(0, 10), spark.range(5, 12).union(spark.range(5, 7))
    row = v.pairing_gaps(a, b, "id").first()
    assert (row.n_paired, row.n_left_only, row.n_right_only) == (5, 5, 2)
