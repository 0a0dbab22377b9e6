import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, scorecard

SCHEMA = "customer_id string, tenure_months int, monthly_charges double, total_charges double, contract_type string, internet_service string"


def people(spark):
    return spark.createDataFrame(
        [
            ("a", 12, 50.0, 600.0, "One year", "DSL"),
            ("b", 24, 60.0, 1440.0, "Two year", None),
            ("c", 36, 70.0, 2520.0, None, "No"),
            ("d", None, None, float("nan"), "One year", "DSL"),
        ],
        SCHEMA,
    )


def test_values(spark):
    rows = {r.customer_id: r for r in features.add_features(people(spark)).collect()}
    a, b, c, d = (rows[k] for k in "abcd")
    assert a.tenure_years == 1.0 and (a.is_new_customer, a.is_long_term_customer) == (1, 0)
    assert (c.is_new_customer, c.is_long_term_customer) == (0, 1)
    assert a.avg_monthly_spend == pytest.approx(600 / 13)
    assert a.current_to_avg_ratio == pytest.approx(50 / (600 / 13 + 0.01))
    assert b.total_spend_ratio == pytest.approx(60 / 1440.01)
    assert [r.service_count for r in (a, b, c, d)] == [1, 0, 1, 1]
    assert [r.is_high_value for r in (a, b, c, d)] == [0, 0, 1, 0]  # the median is 60


def test_missing_inputs_give_zero_flags_and_missing_numbers(spark):
    d = features.add_features(people(spark)).where("customer_id = 'd'").first()
    assert (d.is_new_customer, d.is_long_term_customer, d.is_high_value) == (0, 0, 0)
    assert d.tenure_years is None and d.avg_monthly_spend is None and d.total_spend_ratio is None


def test_stored_median_makes_features_independent_of_the_batch(spark):
    median = features.fit_median_charge(people(spark))
    one = people(spark).where("customer_id = 'c'")
    assert median == 60.0
    assert features.add_features(one, median).first().is_high_value == 1
    assert features.add_features(one).first().is_high_value == 0


def test_features_follow_the_columns_at_hand(spark):
    only_tenure = features.add_features(people(spark).select("tenure_months"))
    assert only_tenure.columns == ["tenure_months", "tenure_years", "is_new_customer", "is_long_term_customer"]
    half = spark.createDataFrame([(18,)], "tenure_months int")
    assert features.add_features(half).first().tenure_years == 1.5
    assert set(features.add_features(people(spark)).columns) >= set(features.DERIVED_FEATURES)


def test_zero_denominator_is_missing_not_an_error(spark):
    df = spark.createDataFrame([(-1, 1.0, -0.01)], "tenure_months int, monthly_charges double, total_charges double")
    row = features.add_features(df).first()
    assert row.avg_monthly_spend is None and row.total_spend_ratio is None


def test_scorecard_points_and_clipping(spark):
    rows = [
        (3, "Month-to-month", "Electronic check", 100.0, "Fiber optic", 0.85),
        (48, "Two year", "Credit card", 30.0, "No", 0.05),
        (8, "One year", "Mailed check", 50.0, "DSL", 0.35),
        (None, None, None, None, None, 0.15),
    ]
    df = spark.createDataFrame(
        rows,
        "tenure_months int, contract_type string, payment_method string, monthly_charges double, internet_service string, want double",
    )
    for r in scorecard.score(df).collect():
        assert r.churn_probability == pytest.approx(r.want)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.49,)], "p double")
    assert [r.f for r in df.select(scorecard.high_risk(F.col("p")).alias("f")).collect()] == [True, False]


def test_threshold_sweep(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (0.6,), (0.9,)], "p double")
    rows = scorecard.threshold_sweep(df, "p", [0.3, 0.7]).collect()
    assert [(r.threshold, r.n_high_risk, r.n_scored) for r in rows] == [(0.3, 3, 4), (0.7, 1, 4)]
