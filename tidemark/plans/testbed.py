"""Customer, prediction and attribution tables derived from a star schema and an event table.

Features use orders up to 180 days before the last order only; a customer without an order in
those last days has left. Charges are unknown for accounts in debt and the payment method for
very rich ones, which gives imputation something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.outcomes import current_state
from tidemark.operators.scorecard import Scorecard, high_risk, score

HOLDOUT = "INTERVAL 180 DAYS"

# The attrition card's points on this data's categories and value ranges.
ORDERS_CARD = Scorecard(
    base=0.15,
    rules=(
        ("tenure_months < 60", 0.30),
        ("tenure_months >= 60 AND tenure_months < 70", 0.20),
        ("tenure_months >= 74", -0.15),
        ("contract_type = 'BUILDING'", 0.25),
        ("contract_type = 'MACHINERY'", -0.20),
        ("payment_method = '1-URGENT'", 0.15),
        ("payment_method = '5-LOW'", -0.10),
        ("monthly_charges > 260000", 0.15),
        ("internet_service = 'F'", 0.10),
    ),
)


# The columns used here, declared so that opening a table reads no file footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with an order before the cut-off. Orders are read once and shuffled
    once, after partial aggregation, on the customer key."""
    orders = table(spark, sf_dir, "orders")
    cutoff = orders.agg((F.max("o_orderdate") - F.expr(HOLDOUT)).alias("c")).scalar()
    early = F.col("o_orderdate") <= F.col("cutoff")
    per_customer = (
        orders.withColumn("cutoff", cutoff)
        .groupBy("o_custkey")
        .agg(
            F.count_if(early).alias("n_orders"),
            F.min(F.when(early, F.col("o_orderdate"))).alias("first_order"),
            F.max("cutoff").alias("cutoff"),
            # whole cents: exact in any order of summation
            (F.sum(F.when(early, (F.col("o_totalprice") * 100 + 0.5).cast("bigint"))) / 100.0).alias("total"),
            F.mode(F.when(early, F.col("o_orderpriority")), True).alias("priority"),
            F.mode(F.when(early, F.col("o_orderstatus")), True).alias("status"),
            F.count_if(~early).alias("n_later"),
        )
        .where(F.col("n_orders") > 0)
    )
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    joined = per_customer.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.format_string("CUST_%04d", "c_custkey").alias("customer_id"),
        F.floor(F.datediff("cutoff", "first_order") / 30).cast("int").alias("tenure_months"),
        F.when(F.col("c_acctbal") >= 0, F.col("total") / F.col("n_orders")).alias("monthly_charges"),
        F.col("total").alias("total_charges"),
        F.col("c_mktsegment").alias("contract_type"),
        F.when(F.col("c_acctbal") <= 9500, F.col("priority")).alias("payment_method"),
        F.col("status").alias("internet_service"),
        (F.col("n_later") == 0).cast("int").alias("churn"),
        F.round((F.col("c_acctbal") + 1000.0) / 11000.0, 6).alias("account_score"),
    )


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a scorecard probability (many ties), its class and a version per service."""
    return (
        score(customers(spark, sf_dir), ORDERS_CARD)
        .withColumn("is_high_risk", high_risk(F.col("churn_probability")))
        .withColumn("predicted_class", F.col("is_high_risk").cast("int"))
        .withColumn("model_version", F.concat(F.lit("v_"), F.lower("internet_service")))
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def predictions_of(events: DataFrame) -> DataFrame:
    """View and click events as logged predictions of two model versions."""
    return events.where(F.col("event_type").isin("view", "click")).select(
        F.concat(F.lit("PRED_"), F.col("event_id").cast("string")).alias("prediction_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("v_"), F.col("event_type")).alias("model_version"),
        F.round(F.col("value") / (F.col("value") + 50.0), 6).alias("prediction"),
        (F.col("value") >= 50.0).cast("int").alias("predicted_class"),
        F.lit(None).cast("int").alias("actual_outcome"),
        F.col("ts").cast("timestamp").alias("prediction_timestamp"),
        F.lit(None).cast("timestamp").alias("outcome_timestamp"),
        F.col("props").alias("features"),
    )


def outcomes_of(events: DataFrame) -> DataFrame:
    """Each other event decides the two events before it; a purchase is outcome 1."""
    decided = F.explode(F.array(F.col("event_id") - 1, F.col("event_id") - 2))
    return events.where(F.col("event_type").isin("purchase", "signup", "error")).select(
        decided.alias("of"), "event_type", "ts"
    ).select(
        F.concat(F.lit("PRED_"), F.col("of").cast("string")).alias("prediction_id"),
        (F.col("event_type") == "purchase").cast("int").alias("actual_outcome"),
        F.col("ts").cast("timestamp").alias("outcome_timestamp"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_of(_events(spark, sf_dir))


def outcome_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_of(_events(spark, sf_dir))


def resolved_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(prediction_log(spark, sf_dir), outcome_events(spark, sf_dir))


ATTRIBUTION_WIDTH = 64


def attribution_names(width: int) -> list[str]:
    return [f"f{i}" for i in range(width)]


def attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding vectors taken as an attribution matrix: (vec_id, shap, base_value, margin,
    is_high_risk). The margin is the base plus the first half of the vector, so that the
    additivity check finds rows on both sides of its tolerance."""
    vectors = table(spark, sf_dir, "embeddings")
    shap = F.transform("embedding", lambda v: v.cast("double"))
    return vectors.select("vec_id", shap.alias("shap"), F.lit(0.25).alias("base_value"), "label").withColumn(
        "margin",
        F.col("base_value") + F.aggregate(F.slice("shap", 1, ATTRIBUTION_WIDTH // 2), F.lit(0.0), lambda a, v: a + v),
    ).withColumn("is_high_risk", F.col("label") >= 5)
