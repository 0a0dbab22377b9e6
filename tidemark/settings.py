"""Shared names, thresholds and default hyper-parameters."""

from __future__ import annotations

from pyspark.sql import types as T

# The customer schema and the numbers that decide results.
NUMERIC_FEATURES = ["tenure_months", "monthly_charges", "total_charges"]
CATEGORICAL_FEATURES = ["contract_type", "payment_method", "internet_service"]
TARGET = "churn"
ID_COLUMN = "customer_id"

MIN_RECALL = 0.85
HIGH_RISK_THRESHOLD = 0.5
TEST_FRACTION = 0.2
RANDOM_SEED = 42
TOP_FEATURES = 5
BACKGROUND_ROWS = 100
POSITIVE_WEIGHT_BOOST = 7.5

DEFAULT_PARAMS = {
    "objective": "binary:logistic",
    "eval_metric": "logloss",
    "max_depth": 6,
    "learning_rate": 0.03,
    "n_estimators": 300,
    "subsample": 0.9,
    "colsample_bytree": 0.9,
    "min_child_weight": 1,
    "gamma": 0,
    "reg_alpha": 0.05,
    "reg_lambda": 0.5,
    "scale_pos_weight": 1,
    "random_state": 42,
}

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField(ID_COLUMN, T.StringType()),
        T.StructField("tenure_months", T.IntegerType()),
        T.StructField("monthly_charges", T.DoubleType()),
        T.StructField("total_charges", T.DoubleType()),
        T.StructField("contract_type", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("internet_service", T.StringType()),
        T.StructField(TARGET, T.IntegerType()),
    ]
)
