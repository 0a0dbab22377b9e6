"""Named queries over the driver tables: one per operator.

Each takes a session and the folder of the tables and returns a table. Doubles are rounded to six
places, as the SQL counterparts in ``oracle`` do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.operators import alerts, classification, curves, distribution, encoding, explanations
from tidemark.operators import features as feature_ops
from tidemark.operators import outcomes, rules, sampling, scorecard, scoring, training, validation
from tidemark.operators import tree_walk
from tidemark.operators.attribution import LeafTable, read_leaf_table, save_classifier
from tidemark.plans import testbed
from tidemark.plans.training_run import METRICS
from tidemark.sources import alert_log, customers, prediction_log, registry
from tidemark.sources.scratch import new_folder
from tidemark.streaming import outcomes as outcome_stream
from tidemark.streaming import performance, sources
from tidemark.streaming import scoring as score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SMALL = {**settings.DEFAULT_PARAMS, "n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}  # the second version that is compared
RANGES = {"tenure_months": (1, 73), "monthly_charges": (150000, 350000), "total_charges": (0, 1e9)}
THRESHOLDS = [0.3, 0.5, 0.7]
ISO = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    """All doubles to six places."""
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- scans, records and checks -------------------------------------------------------------------


@query
def customer_scan(spark, sf):
    return rounded(testbed.customers(spark, sf))


@query
def records_to_columns(spark, sf):
    c = testbed.customers(spark, sf)
    pairs = [x for n in scoring.FEATURES for x in (F.lit(n), F.col(n).cast("string"))]
    return rounded(scoring.records_from_maps(c.select("customer_id", F.create_map(*pairs).alias("features"))))


@query
def log_text_scan(spark, sf):
    log = testbed.resolved_log(spark, sf)
    text = log.select(
        *[
            F.concat(F.lit(" "), F.coalesce(F.col(n).cast("string"), F.lit(""))).alias(n)
            for n in prediction_log.LOG_SCHEMA.names
        ]
    ).withColumn("prediction_id", F.when(F.trim("customer_id") != "8", F.col("prediction_id")).otherwise(" "))
    return prediction_log.parse_log_text(text).select(
        "prediction_id",
        "customer_id",
        "model_version",
        "prediction",
        "predicted_class",
        "actual_outcome",
        F.date_format("prediction_timestamp", ISO).alias("predicted_at"),
        F.date_format("outcome_timestamp", ISO).alias("decided_at"),
        F.col("features")["k"].alias("feature_k"),
    )


@query
def emptiness_check(spark, sf):
    return validation.emptiness(testbed.table(spark, sf, "events"))


@query
def csv_roundtrip(spark, sf):
    """Customers written as CSV and read back with the typed reader."""
    folder = new_folder(spark, "customers-csv")
    customers.write_table(testbed.customers(spark, sf).drop("account_score"), folder, "csv")
    return rounded(customers.read_csv(spark, folder))


@query
def schema_check(spark, sf):
    """Everything wrong with the schema of customers and of three spoilt variants."""
    c = testbed.customers(spark, sf)
    tables = {
        "as it is": c,
        "text charges": c.withColumn("monthly_charges", F.col("monthly_charges").cast("string")),
        "no contract": c.drop("contract_type"),
        "no label": c.drop("churn"),
    }
    rows = [(n, "; ".join(validation.schema_errors(t, validation.CUSTOMER_SPEC, training=True))) for n, t in tables.items()]
    return spark.createDataFrame(rows, "table_name string, errors string")


STORED = ("customer", "orders", "events", "documents", "labels", "lineitem", "conversations")
LIMIT = 1000


@query
def stored_schemas(spark, sf):
    """What the schema check says of the given files, column by column, when every column is to be numeric and a category."""
    rows = []
    for name in STORED:
        given = spark.read.parquet(f"{sf}/{name}.parquet")
        spec = validation.TableSpec(required=[*given.columns, "no_such_column"], numeric=given.columns, categorical=given.columns, target="no_label")
        rows += [(name, error) for error in validation.schema_errors(given, spec, training=True)]
    return spark.createDataFrame(rows, "table_name string, error string")


@query
def batch_guard(spark, sf):
    """Which of the given tables a limit of 1000 rows refuses."""
    rows = []
    for name in STORED:
        given = spark.read.parquet(f"{sf}/{name}.parquet")
        try:
            validation.check_max_rows(given, LIMIT)
            rows.append((name, None))
        except ValueError as refused:
            rows.append((name, str(refused)))
    return spark.createDataFrame(rows, "table_name string, refusal string")


@query
def unreadable_records(spark, sf):
    """Records with texts for numbers: every feature that cannot be read."""
    c = testbed.customers(spark, sf)
    spoilt = F.when(F.col("tenure_months") % 5 == 0, F.concat(F.col("tenure_months").cast("string"), F.lit(" months"))).otherwise(F.col("tenure_months").cast("string"))
    charges = F.when(F.col("contract_type") == "BUILDING", F.lit("n/a")).otherwise(F.col("monthly_charges").cast("string"))
    features = F.create_map(F.lit("tenure_months"), spoilt, F.lit("monthly_charges"), charges)
    return scoring.unreadable_records(c.select("customer_id", features.alias("features")))


@query
def range_report(spark, sf):
    return rounded(validation.range_report(testbed.customers(spark, sf), RANGES))


@query
def range_violations(spark, sf):
    return rounded(
        validation.range_violations(testbed.customers(spark, sf), RANGES).select(
            "customer_id", F.array_join("out_of_range", ",").alias("out_of_range")
        )
    )


@query
def record_check(spark, sf):
    c = testbed.customers(spark, sf)
    blank = c.withColumn("customer_id", F.when(F.col("tenure_months") < 60, F.lit("  ")).otherwise(F.col("customer_id")))
    checked = validation.record_problems(blank, ["monthly_charges", "payment_method"])
    return checked.groupBy(F.array_join("problems", "; ").alias("problems")).agg(F.count(F.lit(1)).alias("n"))


@query
def map_record_check(spark, sf):
    c = testbed.customers(spark, sf)
    known = F.map_filter(
        F.create_map(*[x for n in scoring.FEATURES for x in (F.lit(n), F.col(n).cast("string"))]),
        lambda k, v: v.isNotNull(),
    )
    checked = validation.map_record_problems(c.select("customer_id", known.alias("features")), scoring.FEATURES)
    return checked.groupBy(F.array_join("problems", "; ").alias("problems")).agg(F.count(F.lit(1)).alias("n"))


@query
def log_domain_check(spark, sf):
    events = testbed.table(spark, sf, "events")
    rows = events.select(
        "event_id",
        (F.col("value") / 200.0).alias("prediction"),
        F.floor(F.col("value") / 150.0).cast("int").alias("predicted_class"),
        F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", 2).alias("actual_outcome"),
    )
    return validation.log_row_problems(rows).select(
        "event_id", F.array_join("problems", "; ").alias("problems"), (F.size("problems") == 0).alias("is_good")
    )


@query
def pairing_check(spark, sf):
    return validation.pairing_gaps(testbed.table(spark, sf, "documents"), testbed.table(spark, sf, "labels"), "doc_id")


def _configurations(spark: SparkSession, sf: str) -> DataFrame:
    """Hyper-parameter settings made from orders: five parameters per order."""
    o = testbed.table(spark, sf, "orders")

    def entry(param, value, kind):
        return F.struct(F.lit(param).alias("param"), value.cast("string").alias("value"), F.lit(kind).alias("value_type"))

    rate = F.format_string("%.10f", F.col("o_totalprice") / 400000.0)
    share = F.format_string("%.10f", 1.5 - F.col("o_totalprice") / 250000.0)
    trees = F.dayofmonth("o_orderdate") - 1
    method = F.when(F.col("o_orderpriority") == "1-URGENT", "hist").when(
        F.col("o_orderpriority") == "2-HIGH", "fastest"
    )
    depth = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("config_id"),
        F.inline(
            F.array(
                entry("learning_rate", rate, "float"),
                entry("subsample", share, "float"),
                entry("n_estimators", trees, "int"),
                entry("tree_method", method, "str"),
                entry("max_depth", depth, "str"),
                entry("not_a_parameter", F.lit("x"), "str"),
            )
        ),
    )


@query
def rule_violations(spark, sf):
    return rules.rule_violations(_configurations(spark, sf))


@query
def violations_per_config(spark, sf):
    listed = rules.violations_per_config(_configurations(spark, sf))
    return listed.select("config_id", "n_errors", F.array_join("errors", "; ").alias("errors"))


# Values that the numeric rules are tried on, as (text, type); names of enumerations get all that are allowed and three others.
TRIED = [
    ("-1", "int"), ("0", "int"), ("1", "int"), ("2", "int"), ("-0.5", "float"), ("0.0", "float"), ("0.5", "float"), ("1.0", "float"),
    ("1.5", "float"), ("nan", "float"), ("True", "bool"), ("False", "bool"), ("abc", "str"), (None, "str"),
]
OTHERS = ["fastest", "", None]


def tried_values() -> dict[str, list[tuple[str | None, str]]]:
    """Every parameter that has a rule, with the values to try."""
    numbers = {r[0]: TRIED for r in rules.NUMERIC_RULES}
    return numbers | {n: [(v, "str") for v in [*allowed, *OTHERS]] for n, allowed in rules.ENUM_RULES.items()}


@query
def rule_violations_of_all(spark, sf):
    """Every parameter's rule on every kind of value: an order is a configuration that picks one value for each."""
    listed = list(enumerate(tried_values().items()))
    params = spark.createDataFrame([(i, param, len(values)) for i, (param, values) in listed], "number int, param string, n int")
    tried = [(i, at, v, t) for i, (_, values) in listed for at, (v, t) in enumerate(values)]
    values = spark.createDataFrame(tried, "number int, at bigint, value string, value_type string")
    # both as small as the rules; written out as one expression, the choices would be made anew for every order
    o = testbed.table(spark, sf, "orders").select(F.col("o_orderkey").alias("config_id")).crossJoin(F.broadcast(params))
    picked = o.withColumn("at", (F.col("config_id") + F.col("number")) % F.col("n")).join(F.broadcast(values), ["number", "at"])
    configs = picked.select("config_id", "param", "value", "value_type")
    return rules.rule_violations(configs)


@query
def recall_gate(spark, sf):
    e = classification.evaluate(testbed.scored_customers(spark, sf), "churn", "churn_probability", "predicted_class")
    return rounded(classification.meets_recall(e, 0.3).select("model_version", "recall", "meets_threshold"))


@query
def log_retrieval(spark, sf):
    log = testbed.resolved_log(spark, sf)
    found = outcomes.retrieve(
        log, model_version="v_view", has_outcome=True, start="2024-01-05 00:00:00", end="2024-01-20 12:00:00"
    )
    return found.select(
        "prediction_id", "customer_id", "prediction", "actual_outcome", F.date_format("prediction_timestamp", ISO).alias("predicted_at")
    )


@query
def latest_predictions(spark, sf):
    found = outcomes.retrieve(testbed.resolved_log(spark, sf), has_outcome=False, limit=25)
    return found.select("prediction_id", F.date_format("prediction_timestamp", ISO).alias("predicted_at"))


# --- features and encoding -----------------------------------------------------------------------


@query
def customer_features(spark, sf):
    # not rounded: both engines do the same arithmetic on the same doubles
    return feature_ops.add_features(testbed.customers(spark, sf)).select("customer_id", *feature_ops.DERIVED_FEATURES)


@query
def customer_features_fitted(spark, sf):
    c = testbed.customers(spark, sf)
    median = feature_ops.fit_median_charge(c.where(F.col("churn") == 0))
    return rounded(feature_ops.add_features(c, median).select("customer_id", "is_high_value", "total_spend_ratio"))


@query
def attrition_score(spark, sf):
    return testbed.scored_customers(spark, sf).select("customer_id", "churn_probability", "is_high_risk")


@query
def attrition_label_draw(spark, sf):
    s = testbed.scored_customers(spark, sf)
    return scorecard.draw_label(s, "churn_probability", 7, output="drawn").select("customer_id", "drawn")


@query
def threshold_sweep(spark, sf):
    return scorecard.threshold_sweep(testbed.scored_customers(spark, sf), "churn_probability", THRESHOLDS)


@query
def display_table(spark, sf):
    return distribution.display_rows(
        testbed.scored_customers(spark, sf), "churn_probability", "is_high_risk", "customer_id"
    )


@query
def flat_results(spark, sf):
    log = testbed.prediction_log(spark, sf)
    top = F.array(F.struct(F.lit("k").alias("feature"), F.col("prediction").alias("shap_value")))
    return scoring.flat_results(
        log.select("prediction_id", "prediction_timestamp", F.when(F.col("predicted_class") == 1, top).alias("top_features"))
    )


def _engineered(spark: SparkSession, sf: str) -> DataFrame:
    return feature_ops.add_features(testbed.customers(spark, sf).drop("account_score"))


@query
def numeric_stats(spark, sf):
    numeric, _ = encoding.route_columns(_engineered(spark, sf))
    return rounded(encoding.numeric_stats(_engineered(spark, sf), numeric))


@query
def category_counts(spark, sf):
    return encoding.category_counts(testbed.customers(spark, sf), settings.CATEGORICAL_FEATURES)


@query
def category_modes(spark, sf):
    return encoding.category_modes(category_counts(spark, sf))


@query
def encoded_customers(spark, sf):
    c = testbed.customers(spark, sf)
    seen = c.where(F.col("contract_type") != "FURNITURE")  # so that one category is unseen when applied
    encoder = encoding.fit_encoder(seen, settings.NUMERIC_FEATURES, settings.CATEGORICAL_FEATURES)
    wide = encoder.transform_wide(c, ["customer_id"])
    return rounded(wide.toDF(*[n.lower().replace("-", "_").replace(" ", "_") for n in wide.columns]))


@query
def class_weights(spark, sf):
    c = testbed.customers(spark, sf)
    return training.with_weight(c, "churn", 7.5, "weight").groupBy("churn").agg(F.sum("weight").alias("total_weight"))


@query
def positive_weight(spark, sf):
    return rounded(classification.positive_weight(testbed.customers(spark, sf), "churn"))


# --- splits, samples and joins -------------------------------------------------------------------


@query
def hash_split(spark, sf):
    return sampling.split_by_hash(testbed.customers(spark, sf)).select("customer_id", "is_test")


@query
def stratified_split(spark, sf):
    return sampling.stratified_split(testbed.customers(spark, sf), "churn").select("customer_id", "churn", "is_test")


@query
def random_sample(spark, sf):
    return sampling.sample_rows(testbed.customers(spark, sf).select("customer_id"), 100)


@query
def background_sample(spark, sf):
    c = testbed.customers(spark, sf).where(F.col("churn") == 1).select("customer_id")
    return sampling.sample_rows(c, settings.BACKGROUND_ROWS, seed=settings.RANDOM_SEED + 1)


@query
def first_customers(spark, sf):
    return sampling.first_rows(testbed.customers(spark, sf).select("customer_id", "churn"), 150)


@query
def predictions_with_explanations(spark, sf):
    a = testbed.attributions(spark, sf)
    top = a.where("is_high_risk").select(
        "vec_id", explanations.top_features(F.col("shap"), testbed.attribution_names(64), 1).alias("top_features")
    )
    joined = explanations.attach_explanations(a.select("vec_id", "margin"), top, "vec_id")
    return rounded(joined.select("vec_id", "margin", F.col("top_features")[0]["feature"].alias("first_feature")))


@query
def predictions_with_labels(spark, sf):
    s = testbed.scored_customers(spark, sf)
    labels = testbed.customers(spark, sf).select("customer_id", F.col("churn").alias("actual"))
    joined = explanations.attach_labels(s.select("customer_id", "predicted_class"), labels)
    return joined.withColumn("is_right", F.col("predicted_class") == F.col("actual"))


def _raw_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors whose top feature names partly exist as columns of a raw table."""
    a = testbed.attributions(spark, sf)
    explained = a.select(
        "vec_id", explanations.top_features(F.col("shap"), testbed.attribution_names(64), 5).alias("top_features")
    )
    raw = a.select("vec_id", *[F.round(F.col("shap")[i], 6).alias(f"f{i}") for i in range(0, 32)])
    return explained, raw


@query
def top_features_with_raw_values(spark, sf):
    explained, raw = _raw_pair(spark, sf)
    joined = explanations.with_raw_values(explained, raw, "vec_id")
    return rounded(joined.withColumn("feature_value", F.col("feature_value").cast("double")))


@query
def log_with_outcomes(spark, sf):
    return testbed.resolved_log(spark, sf).select(
        "prediction_id", "predicted_class", "actual_outcome", F.date_format("outcome_timestamp", ISO).alias("decided_at")
    )


@query
def unmatched_outcomes(spark, sf):
    missing = outcomes.unmatched_outcomes(testbed.prediction_log(spark, sf), testbed.outcome_events(spark, sf))
    return missing.select("prediction_id", "actual_outcome", F.date_format("outcome_timestamp", ISO).alias("decided_at"))


# --- metrics -------------------------------------------------------------------------------------


def _counts(spark: SparkSession, sf: str, by: list[str]) -> DataFrame:
    return classification.confusion_counts(testbed.scored_customers(spark, sf), "churn", "predicted_class", by)


@query
def confusion_matrix(spark, sf):
    matrix = classification.with_matrix(_counts(spark, sf, ["model_version"]))
    return matrix.select("model_version", *classification.COUNTS, F.to_json("confusion_matrix").alias("matrix"))


@query
def precision_recall_f1(spark, sf):
    return rounded(classification.with_metrics(_counts(spark, sf, ["contract_type"])))


@query
def confusion_rates(spark, sf):
    return rounded(classification.with_rates(_counts(spark, sf, ["contract_type"])))


@query
def classification_report(spark, sf):
    return rounded(classification.classification_report(_counts(spark, sf, [])))


@query
def matthews_and_kappa(spark, sf):
    return rounded(
        classification.with_kappa(classification.with_matthews(_counts(spark, sf, ["contract_type"]))).select(
            "contract_type", "matthews", "kappa"
        )
    )


@query
def roc_auc(spark, sf):
    return rounded(classification.roc_auc(testbed.scored_customers(spark, sf), "churn", "churn_probability"))


@query
def roc_auc_by_segment(spark, sf):
    return rounded(
        classification.roc_auc(testbed.scored_customers(spark, sf), "churn", "account_score", ["contract_type"])
    )


@query
def evaluation_by_segment(spark, sf):
    s = testbed.scored_customers(spark, sf)
    return rounded(
        classification.evaluate(s, "churn", "churn_probability", "predicted_class", ["contract_type"])
    )


@query
def evaluation_rows(spark, sf):
    s = testbed.scored_customers(spark, sf).withColumn(
        "model_version", F.when(F.col("model_version") != "v_p", F.col("model_version"))
    )
    return rounded(
        classification.evaluation_rows(
            s, "churn", "churn_probability", "predicted_class", F.lit("2024-01-31")
        )
    )


@query
def roc_points(spark, sf):
    return rounded(curves.roc_curve(testbed.scored_customers(spark, sf), "churn", "account_score"))


@query
def score_cdf(spark, sf):
    return rounded(curves.empirical_cdf(testbed.scored_customers(spark, sf), "account_score"))


@query
def score_cdf_by_outcome(spark, sf):
    return rounded(curves.empirical_cdf(testbed.scored_customers(spark, sf), "churn_probability", ["churn"]))


@query
def calibration_uniform(spark, sf):
    return rounded(curves.calibration_curve(testbed.scored_customers(spark, sf), "churn", "churn_probability"))


@query
def calibration_quantile(spark, sf):
    return rounded(
        curves.calibration_curve(testbed.scored_customers(spark, sf), "churn", "account_score", 8, "quantile")
    )


@query
def calibration_error(spark, sf):
    curve = curves.calibration_curve(testbed.scored_customers(spark, sf), "churn", "churn_probability")
    return rounded(curves.calibration_error(curve))


@query
def score_summary(spark, sf):
    return rounded(distribution.score_summary(testbed.scored_customers(spark, sf), "churn_probability"))


@query
def risk_summary(spark, sf):
    return rounded(distribution.risk_summary(testbed.scored_customers(spark, sf), "churn_probability", 0.5))


@query
def churn_rate(spark, sf):
    return rounded(classification.class_balance(testbed.customers(spark, sf), "churn"))


@query
def retention_summary(spark, sf):
    return rounded(
        classification.retention_summary(testbed.scored_customers(spark, sf), "churn", "churn_probability", 0.5)
    )


@query
def score_histogram(spark, sf):
    return rounded(distribution.histogram(testbed.scored_customers(spark, sf), "account_score"))


@query
def charge_histogram(spark, sf):
    return rounded(distribution.histogram(testbed.customers(spark, sf), "monthly_charges", 20, bounds=None))


@query
def score_histogram_by_outcome(spark, sf):
    return rounded(distribution.histogram(testbed.scored_customers(spark, sf), "account_score", 20, by="churn"))


@query
def charge_box_plot(spark, sf):
    return rounded(distribution.five_numbers(testbed.customers(spark, sf), "monthly_charges", ["churn"]))


@query
def score_box_plot(spark, sf):
    return rounded(distribution.five_numbers(testbed.scored_customers(spark, sf), "churn_probability", ["churn"]))


@query
def score_band_outcomes(spark, sf):
    return distribution.score_band_outcomes(testbed.scored_customers(spark, sf), "churn_probability", "churn")


@query
def column_profile(spark, sf):
    return rounded(distribution.column_profile(testbed.customers(spark, sf)))


@query
def log_statistics(spark, sf):
    return rounded(outcomes.log_statistics(testbed.resolved_log(spark, sf)))


@query
def log_statistics_by_version(spark, sf):
    return rounded(outcomes.log_statistics(testbed.resolved_log(spark, sf), ["model_version"]))


# --- attributions --------------------------------------------------------------------------------


NAMES = testbed.attribution_names(testbed.ATTRIBUTION_WIDTH)


@query
def top_features(spark, sf):
    a = testbed.attributions(spark, sf)
    top = a.select("vec_id", F.posexplode(explanations.top_features(F.col("shap"), NAMES)).alias("rank", "t"))
    return rounded(
        top.select(
            "vec_id", (F.col("rank") + 1).alias("rank"), "t.feature", "t.shap_value", explanations.impact(F.col("t.shap_value")).alias("impact")
        )
    )


@query
def additivity_check(spark, sf):
    return rounded(explanations.additivity_check(testbed.attributions(spark, sf), "shap", "base_value", "margin", 0.5))


@query
def mean_magnitude(spark, sf):
    return rounded(explanations.mean_magnitude(testbed.attributions(spark, sf), "shap", NAMES))


@query
def top_feature_importance(spark, sf):
    a = testbed.attributions(spark, sf)
    listed = a.select(explanations.top_features(F.col("shap"), NAMES).alias("top_features"))
    return rounded(explanations.top_feature_importance(listed))


@query
def risk_group_difference(spark, sf):
    return rounded(explanations.risk_group_difference(testbed.attributions(spark, sf), "shap", "is_high_risk", NAMES))


# --- versions, alerts and trends -----------------------------------------------------------------


def daily_evaluations(spark: SparkSession, sf: str) -> DataFrame:
    """One evaluation per day of resolved predictions, as if each day had its own version."""
    log = testbed.resolved_log(spark, sf).where(F.col("actual_outcome").isNotNull())
    dated = log.withColumn("day", F.date_format("prediction_timestamp", "yyyy-MM-dd")).withColumn(
        "model_version", F.concat(F.lit("v_"), F.regexp_replace("day", "-", ""))
    )
    e = classification.evaluate(dated, "actual_outcome", "prediction", "predicted_class", ["model_version", "day"])
    return e.withColumn("evaluation_date", F.to_timestamp("day"))


def _version_metadata(spark: SparkSession, sf: str) -> DataFrame:
    e = daily_evaluations(spark, sf)
    pairs = [x for m in METRICS for x in (F.lit(m), F.col(m))]
    return e.select(
        F.col("model_version").alias("version"),
        F.concat("day", F.lit("T00:00:00.000000")).alias("timestamp"),
        F.create_map(*pairs).alias("metrics"),
    )


def _version_events(spark: SparkSession, sf: str) -> DataFrame:
    """Good days are deployed at noon, bad ones deleted in the evening."""
    e = daily_evaluations(spark, sf)
    noon = F.col("evaluation_date") + F.expr("INTERVAL 12 HOURS")
    evening = F.col("evaluation_date") + F.expr("INTERVAL 20 HOURS")
    version = F.col("model_version").alias("version")
    deployed = F.when(F.col("recall") >= 0.5, F.struct(F.lit("deploy").alias("event"), noon.alias("at")))
    deleted = F.when(F.col("recall") < 0.4, F.struct(F.lit("delete").alias("event"), evening.alias("at")))
    return e.select(version, F.inline(F.array_compact(F.array(deployed, deleted))))


@query
def performance_check(spark, sf):
    checked = classification.meets_recall(daily_evaluations(spark, sf), 0.5)
    return rounded(checked.select("model_version", "recall", "meets_threshold"))


@query
def alert_generation(spark, sf):
    a = alerts.raise_alerts(daily_evaluations(spark, sf), 0.5)
    listed = a.select(
        "alert_id",
        "model_version",
        "alert_type",
        "message",
        "severity",
        F.date_format("timestamp", ISO).alias("raised_at"),
        F.col("metrics")["recall"].alias("recall"),
        F.col("metrics")["roc_auc"].alias("roc_auc"),
    )
    return rounded(listed)


@query
def newest_alerts(spark, sf):
    a = alerts.newest_alerts(alerts.raise_alerts(daily_evaluations(spark, sf), 0.5), limit=5)
    return a.select("alert_id", "model_version")


@query
def recall_trend(spark, sf):
    t = classification.trend_summary(daily_evaluations(spark, sf), 0.5)
    return rounded(t.withColumn("first_breach", F.date_format("first_breach", "yyyy-MM-dd")))


@query
def version_comparison(spark, sf):
    return rounded(registry.version_comparison(_version_metadata(spark, sf)))


@query
def latest_version(spark, sf):
    return registry.latest_version(_version_metadata(spark, sf))


@query
def deployed_version(spark, sf):
    return registry.deployed_version(_version_events(spark, sf))


@query
def serving_version(spark, sf):
    return registry.serving_version(_version_metadata(spark, sf), _version_events(spark, sf))


@query
def live_versions(spark, sf):
    return registry.live_versions(_version_metadata(spark, sf), _version_events(spark, sf)).select("version")


# --- storage: what is written comes back -----------------------------------------------------------


@query
def log_append_roundtrip(spark, sf):
    """One batch in which customers have many predictions, some alike: all are logged or reported."""
    log = prediction_log.PredictionLog(spark, new_folder(spark, "log"))
    score = F.least(F.floor("value"), F.lit(1000)) / 1000.0
    batch = testbed.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit("v_1").alias("model_version"),
        score.alias("prediction"),
        (score >= 0.5).cast("int").alias("predicted_class"),
    )
    held = log.append(batch, F.to_timestamp(F.lit("2024-01-31 10:00:00")))
    counts = log.predictions().groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_logged"))
    kept_back = held.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_held"))
    return counts.join(kept_back, "customer_id", "left").select(
        "customer_id", "n_logged", F.coalesce("n_held", F.lit(0)).alias("n_held")
    )


@query
def log_compaction(spark, sf):
    """Half of the predictions are logged, outcomes come for all of them: none is lost."""
    log = prediction_log.PredictionLog(spark, new_folder(spark, "log"))
    given = testbed.prediction_log(spark, sf).where(F.substring("prediction_id", 6, 20).cast("bigint") % 2 == 0)
    log.append(given.drop("actual_outcome", "prediction_timestamp", "outcome_timestamp"), F.to_timestamp(F.lit("2024-01-31")))
    log.append_outcomes(testbed.outcome_events(spark, sf))
    compact = log.compact(new_folder(spark, "compact"))
    waiting = compact.outcomes().agg(F.count(F.lit(1)).alias("n")).scalar()
    return compact.predictions().agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count("actual_outcome").alias("n_with_outcome")
    ).withColumn("n_waiting", waiting)


def _stored_log(spark: SparkSession, sf: str) -> prediction_log.PredictionLog:
    """All predictions and outcomes of the events in a log of files, each logged at its own time."""
    log = prediction_log.PredictionLog(spark, new_folder(spark, "log"))
    given = testbed.prediction_log(spark, sf).drop("actual_outcome", "outcome_timestamp")
    log.append(given, F.col("prediction_timestamp"))
    log.append_outcomes(testbed.outcome_events(spark, sf))
    return log


@query
def log_day_with_outcomes(spark, sf):
    """Predictions of three days with outcomes of any time, read from the files of these days."""
    found = _stored_log(spark, sf).current("2024-01-10", "2024-01-12")
    return found.select("prediction_id", "actual_outcome", F.date_format("outcome_timestamp", ISO).alias("decided_at"))


@query
def newest_logged(spark, sf):
    """The 25 newest predictions of a version without an outcome, from the newest days of a log of files."""
    found = _stored_log(spark, sf).newest(25, model_version="v_view", has_outcome=False)
    return found.select("prediction_id", F.date_format("prediction_timestamp", ISO).alias("predicted_at"))


@query
def alert_log_roundtrip(spark, sf):
    path = new_folder(spark, "alerts")
    alert_log.append_alerts(alerts.raise_alerts(daily_evaluations(spark, sf), 0.5), path)
    read = alert_log.read_alerts(spark, path)
    return rounded(
        read.select(
            "alert_id", "model_version", "severity", F.date_format("timestamp", ISO).alias("raised_at"),
            F.col("metrics")["recall"].alias("recall"),
        )
    )


@query
def metadata_roundtrip(spark, sf):
    """Version metadata with a key of the caller's own, through files and the scan."""
    root = new_folder(spark, "metadata")
    e = daily_evaluations(spark, sf)
    metrics = F.create_map(*[x for m in METRICS for x in (F.lit(m), F.col(m))])
    document = F.struct(
        F.col("model_version").alias("version"),
        F.concat("day", F.lit("T00:00:00.000000")).alias("timestamp"),
        metrics.alias("metrics"),
        F.col("n_samples").alias("training_samples"),
    )
    e.select(F.to_json(document).alias("value"), F.col("model_version").alias("v")).write.partitionBy("v").text(root)
    read = registry.scan_metadata(spark, f"{root}/v=*")
    own = F.get_json_object("document", "$.training_samples").alias("training_samples")
    return rounded(read.select("version", "timestamp", F.col("metrics")["recall"].alias("recall"), own))


@query
def encoder_reload(spark, sf):
    """The encoder saved and loaded again gives the columns that it gave before."""
    c = testbed.customers(spark, sf)
    seen = c.where(F.col("contract_type") != "FURNITURE")
    path = new_folder(spark, "encoder")
    encoding.fit_encoder(seen, settings.NUMERIC_FEATURES, settings.CATEGORICAL_FEATURES).save(spark, path)
    wide = encoding.FittedEncoder.load(spark, path).transform_wide(c, ["customer_id"])
    return rounded(wide.toDF(*[n.lower().replace("-", "_").replace(" ", "_") for n in wide.columns]))


# --- scores with gaps ----------------------------------------------------------------------------


def _with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Scored customers of whom a tenth has a NULL score and a tenth NaN."""
    number = F.substring("customer_id", 6, 20).cast("bigint") % 10
    score = F.when(number == 7, F.lit(float("nan"))).when(number != 3, F.col("churn_probability"))
    return testbed.scored_customers(spark, sf).withColumn("churn_probability", score)


@query
def evaluation_with_unscored(spark, sf):
    """All rows count, with or without a score."""
    holes = _with_gaps(spark, sf)
    return rounded(classification.evaluate(holes, "churn", "churn_probability", "predicted_class", ["contract_type"]))


@query
def score_summary_with_gaps(spark, sf):
    return rounded(distribution.score_summary(_with_gaps(spark, sf), "churn_probability"))


@query
def calibration_with_gaps(spark, sf):
    return rounded(curves.calibration_curve(_with_gaps(spark, sf), "churn", "churn_probability"))


@query
def score_cdf_with_gaps(spark, sf):
    return rounded(curves.empirical_cdf(_with_gaps(spark, sf), "churn_probability"))


# --- streams -------------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return sources.table_stream(spark, sf, name, testbed.SCHEMAS[name])


@query
def streamed_scores(spark, sf):
    """Order lines scored as they arrive, by a projection of one table."""
    folder = new_folder(spark, "scores")
    orders = _stream(spark, sf, "orders")
    shaped = orders.select(
        F.format_string("ORDER_%08d", "o_orderkey").alias("customer_id"),
        F.month("o_orderdate").alias("tenure_months"),
        (F.col("o_totalprice") / 5000.0).alias("monthly_charges"),
        F.when(F.col("o_orderstatus") == "F", "Month-to-month")
        .when(F.col("o_orderstatus") == "O", "Two year")
        .otherwise("One year")
        .alias("contract_type"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Electronic check").otherwise("Credit card").alias("payment_method"),
        F.when(F.col("o_orderpriority") == "5-LOW", "No").otherwise("Fiber optic").alias("internet_service"),
    )

    def scorer(df: DataFrame) -> DataFrame:
        scored = scorecard.score(df)
        return scored.select("customer_id", "churn_probability", scorecard.high_risk(F.col("churn_probability")).alias("is_high_risk"))

    score_stream.score_stream(shaped, scorer, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _attached(spark: SparkSession, sf: str) -> DataFrame:
    """All that the stream emits: predictions with an outcome within three hours, and those closed without one."""
    folder = new_folder(spark, "outcomes")
    predictions = testbed.predictions_of(_stream(spark, sf, "events")).drop(
        "actual_outcome", "outcome_timestamp"
    )
    decided = testbed.outcomes_of(_stream(spark, sf, "events"))
    attached = outcome_stream.attach_outcomes(predictions, decided, within="3 hours", delay="1 hour")
    outcome_stream.write_attached(attached, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _with_decided_at(rows: DataFrame) -> DataFrame:
    return rows.select("prediction_id", "actual_outcome", F.date_format("outcome_timestamp", ISO).alias("decided_at"))


@query
def streamed_outcomes(spark, sf):
    """The answered half only, a row per outcome; streamed_outcomes_whole has a row per prediction."""
    return _with_decided_at(_attached(spark, sf).where(F.col("actual_outcome").isNotNull()))


@query
def streamed_outcomes_whole(spark, sf):
    """Every prediction answered within three hours, with its latest outcome, or closed without one by the final watermark."""
    return _with_decided_at(outcome_stream.latest_attached(_attached(spark, sf)))


@query
def streamed_late_outcomes(spark, sf):
    """Outcome events that the stream did not attach."""
    return _with_decided_at(outcome_stream.late_outcomes(testbed.outcome_events(spark, sf), _attached(spark, sf)))


def _closed(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream of latest outcomes has written: a row for every prediction whose three hours are over."""
    folder = new_folder(spark, "latest-outcomes")
    predictions = testbed.predictions_of(_stream(spark, sf, "events")).drop("actual_outcome", "outcome_timestamp")
    decided = testbed.outcomes_of(_stream(spark, sf, "events"))
    latest = outcome_stream.latest_outcomes(predictions, decided, within="3 hours", delay="1 hour")
    outcome_stream.write_attached(latest, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def streamed_latest_outcomes(spark, sf):
    """Every prediction closed by the final watermark, once, with its latest outcome within three hours or none."""
    return _closed(spark, sf).select(
        "prediction_id", "customer_id", "model_version", "actual_outcome", F.date_format("outcome_timestamp", ISO).alias("decided_at")
    )


@query
def streamed_outcomes_out_of_time(spark, sf):
    """Outcome events of closed predictions that their stream could not count."""
    return _with_decided_at(outcome_stream.outcomes_out_of_time(testbed.outcome_events(spark, sf), _closed(spark, sf), "3 hours"))


def _watched(spark: SparkSession, sf: str) -> str:
    """The folder that the daily check of decided events has written to."""
    folder = new_folder(spark, "performance")
    events = _stream(spark, sf, "events")
    decided = events.select(
        F.concat(F.lit("v_"), F.col("event_type")).alias("model_version"),
        (F.col("value") >= 50.0).cast("int").alias("predicted_class"),
        F.round(F.col("value") / (F.col("value") + 50.0), 6).alias("prediction"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("ts").cast("timestamp").alias("outcome_timestamp"),
    ).withColumn("actual_outcome", (F.col("k") >= 50).cast("int"))
    performance.watch_performance(
        decided, f"{folder}/evaluations", f"{folder}/alerts", f"{folder}/checkpoint", threshold=0.45
    ).awaitTermination()
    return folder


@query
def streamed_performance(spark, sf):
    """Confusion counts and exact AUC of the closed days, from a stream of decided events."""
    rows = spark.read.parquet(f"{_watched(spark, sf)}/evaluations").where(F.col("n_samples") > 0)
    day = F.date_format("period_start", "yyyy-MM-dd").alias("day")
    return rounded(rows.select("model_version", day, "tn", "fp", "fn", "tp", "recall", "roc_auc", "n_unscored"))


@query
def streamed_alerts(spark, sf):
    """The alerts that the daily check has written."""
    found = alert_log.read_alerts(spark, f"{_watched(spark, sf)}/alerts")
    metrics = [F.col("metrics")[m].alias(m) for m in ("recall", "precision", "roc_auc")]
    return rounded(found.select("alert_id", "model_version", "severity", F.date_format("timestamp", ISO).alias("raised_at"), *metrics))


# --- models --------------------------------------------------------------------------------------

@dataclass
class Trained:
    """A model of the session with its leaf table and the folder of its classifier, which its node table is read from."""

    model: training.AttritionModel
    leaves: LeafTable
    folder: str

    def nodes(self, spark: SparkSession) -> DataFrame:
        return tree_walk.node_table(spark, self.folder)

    @property
    def depth(self) -> int:
        return self.model.classifier.getMaxDepth()


_MODELS: dict[tuple[str, str, str], Trained] = {}
_PEOPLE: dict[tuple[str, str], DataFrame] = {}


def _people(spark: SparkSession, sf: str) -> DataFrame:
    """The customers as files in the shared folder, written once in a session: the split alone reads them five times, and each
    time would aggregate all orders anew."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PEOPLE:
        c, path = testbed.customers(spark, sf), new_folder(spark, "customers")
        c.write.parquet(path)
        _PEOPLE[key] = spark.read.schema(c.schema).parquet(path)
    return _PEOPLE[key]


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return sampling.train_and_test(sampling.stratified_split(_people(spark, sf).drop("account_score"), "churn"))


def trained(spark: SparkSession, sf: str, params: dict) -> Trained:
    """A model trained on the training part of these customers, once in a session."""
    key = (spark.sparkContext.applicationId, sf, repr(sorted(params.items())))
    if key not in _MODELS:
        model = training.train(_parts(spark, sf)[0], params=params)
        folder = save_classifier(model.classifier, spark)
        _MODELS[key] = Trained(model, read_leaf_table(spark, folder, model.classifier.numFeatures), folder)
    return _MODELS[key]


def model_of(spark: SparkSession, sf: str) -> tuple[training.AttritionModel, LeafTable]:
    """The model of default size and its leaf table."""
    found = trained(spark, sf, settings.DEFAULT_PARAMS)
    return found.model, found.leaves


@query
def model_predictions(spark, sf):
    model, leaves = model_of(spark, sf)
    results = scoring.predict(
        model, _people(spark, sf), "v_1", F.to_timestamp(F.lit("2024-01-31")), leaves=leaves, explain=True
    )
    return rounded(scoring.flat_results(results))


@query
def model_risk_flags(spark, sf):
    model, _ = model_of(spark, sf)
    scored = scoring.score(model, _people(spark, sf))
    return scorecard.threshold_sweep(scored, "churn_probability", THRESHOLDS)


@query
def model_evaluation(spark, sf):
    model, _ = model_of(spark, sf)
    return rounded(scoring.compare_versions({"v_1": model, "v_2": trained(spark, sf, SMALL).model}, _parts(spark, sf)[1]))


@query
def model_attributions(spark, sf):
    model, leaves = model_of(spark, sf)
    table = scoring.explain_table(model, leaves, _people(spark, sf))
    return rounded(explanations.additivity_check(table, "shap", "base_value", "margin", 1e-6))


@query
def model_importance(spark, sf):
    model, leaves = model_of(spark, sf)
    table = scoring.explain_table(model, leaves, _people(spark, sf))
    return rounded(explanations.mean_magnitude(table, "shap", model.feature_names))


@query
def model_gain_importance(spark, sf):
    model, _ = model_of(spark, sf)
    return rounded(training.feature_importance(spark, model))


@query
def model_sample_explanations(spark, sf):
    model, leaves = model_of(spark, sf)
    c = _people(spark, sf)
    sample = sampling.sample_rows(c, 100)
    explained = scoring.predict(model, sample, "v_1", F.to_timestamp(F.lit("2024-01-31")), leaves=leaves, explain=True)
    return rounded(explanations.with_raw_values(explained, sample.select("customer_id", *scoring.FEATURES)))


# --- models against a walk of their node table -----------------------------------------------------------
# What a model says cannot be told in advance, but that two independent ways to it agree on every customer can.

CLOSE = 1e-9


def _far(a: str, b: str) -> Column:
    return F.coalesce(F.abs(F.col(a) - F.col(b)) > CLOSE, F.lit(True))


def _walked(spark: SparkSession, sf: str, params: dict, df: DataFrame, keep: list[str]) -> DataFrame:
    found = trained(spark, sf, params)
    keep = ["customer_id", *keep]
    return tree_walk.walk(scoring.score(found.model, df, keep), found.nodes(spark), found.depth, keep=[*keep, "churn_probability"])


@query
def model_predictions_walked(spark, sf):
    """For every customer: whether the result table and the walk agree, and what is in the row."""
    c = _people(spark, sf)
    found = trained(spark, sf, settings.DEFAULT_PARAMS)
    at = F.to_timestamp(F.lit("2024-01-31"))
    results = scoring.predict(found.model, c, "v_1", at, leaves=found.leaves, explain=True)
    walked = _walked(spark, sf, settings.DEFAULT_PARAMS, c, []).select("customer_id", "walked_probability")
    far = _far("churn_probability", "walked_probability")
    flag = F.col("is_high_risk") == (F.col("walked_probability") >= settings.HIGH_RISK_THRESHOLD)
    return results.join(walked, "customer_id").select(
        "customer_id", "model_version", F.date_format("prediction_timestamp", ISO).alias("predicted_at"),
        (~far).alias("score_agrees"), flag.alias("flag_agrees"), F.size("top_features").alias("n_top"),
    )


@query
def model_risk_flags_walked(spark, sf):
    """The threshold sweep over scores, less the one over walked scores."""
    c = _people(spark, sf)
    walked = _walked(spark, sf, settings.DEFAULT_PARAMS, c, []).withColumn("walked_probability", F.round("walked_probability", 9))
    both = walked.withColumn("churn_probability", F.round("churn_probability", 9))
    one = scorecard.threshold_sweep(both, "churn_probability", THRESHOLDS)
    two = scorecard.threshold_sweep(both, "walked_probability", THRESHOLDS)
    renamed = two.toDF(*[n if n == "threshold" else f"w_{n}" for n in two.columns])
    differences = [(F.col(n) - F.col(f"w_{n}")).alias(n) for n in one.columns if n != "threshold"]
    return rounded(one.join(renamed, "threshold").select("threshold", *differences))


@query
def model_evaluation_walked(spark, sf):
    """The evaluation of two versions from one scan, less the evaluations of walked scores: zero in every column."""
    test = _parts(spark, sf)[1]
    versions = {"v_1": settings.DEFAULT_PARAMS, "v_2": SMALL}
    models = {v: trained(spark, sf, p).model for v, p in versions.items()}
    parts = [
        _walked(spark, sf, p, test, ["churn"]).select(F.lit(v).alias("model_version"), "churn", F.round("walked_probability", 9).alias("score"))
        for v, p in versions.items()
    ]
    walked = parts[0].unionByName(parts[1]).withColumn("class", (F.col("score") > 0.5).cast("int"))
    scored = scoring.score_versions(models, test, ["churn"]).withColumn("churn_probability", F.round("churn_probability", 9))
    one = classification.evaluate(scored, "churn", "churn_probability", "predicted_class")
    two = classification.evaluate(walked, "churn", "score", "class")
    renamed = two.toDF(*[n if n == "model_version" else f"w_{n}" for n in two.columns])
    names = [n for n in one.columns if n != "model_version"]
    joined = one.join(renamed, "model_version")
    return joined.select(
        "model_version", *[F.round(F.col(n) - F.col(f"w_{n}"), 6).cast("double").alias(f"{n}_difference") for n in names if n != "n_samples"], "n_samples"
    )


@query
def model_gain_importance_walked(spark, sf):
    """How many features have an importance other than the sum of gains in the node table, and what all add up to."""
    found = trained(spark, sf, settings.DEFAULT_PARAMS)
    listed = training.feature_importance(spark, found.model, top=len(found.model.feature_names))
    summed = tree_walk.gains(found.nodes(spark), found.model.feature_names).withColumnRenamed("importance", "summed")
    return rounded(
        listed.join(summed, "feature", "full").agg(F.count_if(_far("importance", "summed")).alias("n_disagreeing"), F.sum("summed").alias("total"))
    )


@query
def model_importance_walked(spark, sf):
    """Attributions against walked scores: base and attributions of every customer add up to the walked margin, and the mean
    magnitudes are those of the summed columns."""
    found = trained(spark, sf, settings.DEFAULT_PARAMS)
    walked = _walked(spark, sf, settings.DEFAULT_PARAMS, _people(spark, sf), [])
    explained = scoring.explain_table(found.model, found.leaves, _people(spark, sf)).drop("margin")
    joined = explained.join(walked.select("customer_id", F.col("walked_margin").alias("margin")), "customer_id")
    return rounded(explanations.additivity_check(joined, "shap", "base_value", "margin", 1e-6))


@query
def registry_roundtrip(spark, sf):
    """Three versions saved, one of them twice, one deployed and one deleted: what the registry lists, with metadata and serving version."""
    models = registry.ModelRegistry(spark, f"{new_folder(spark, 'registry')}/models")
    model = trained(spark, sf, SMALL).model
    n = testbed.customers(spark, sf).count()
    for i, version in enumerate(("v_a", "v_b", "v_c", "v_b")):
        models.save(model, version, {"training_samples": n + i, "timestamp": f"2024-01-0{i + 1}T00:00:00.000000"})
    models.deploy("v_a")
    models.delete("v_c")
    serving, loaded = models.load()
    listed = models.versions()
    own = F.get_json_object("document", "$.training_samples").cast("bigint").alias("training_samples")
    return listed.select(
        "version", "timestamp", own, (F.col("version") == F.lit(serving)).alias("serves"), F.lit(len(loaded.feature_names) == len(model.feature_names)).alias("whole")
    )


@query
def model_streamed_predictions(spark, sf):
    """Customers scored and explained as a stream by the registry's serving version: for each, whether its row is that of the batch."""
    folder = new_folder(spark, "served")
    found = trained(spark, sf, SMALL)
    models = registry.ModelRegistry(spark, f"{folder}/models")
    version = models.save(found.model, "v_served")
    models.deploy(version)
    c = testbed.customers(spark, sf).drop("account_score")
    customers.write_table(c, f"{folder}/customers.parquet", "parquet")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in c.schema.fields)
    at = F.to_timestamp(F.lit("2024-01-31"))
    stream = sources.table_stream(spark, folder, "customers", schema)
    score_stream.serve_stream(stream, models, f"{folder}/out", f"{folder}/checkpoint", scored_at=at).awaitTermination()
    batch = scoring.predict(found.model, c, version, at, leaves=found.leaves, explain=True)
    renamed = batch.toDF(*[f"b_{n}" for n in batch.columns])
    same = [F.col(n) == F.col(f"b_{n}") for n in ("is_high_risk", "prediction_timestamp", "model_version")]
    names = F.transform("top_features", lambda t: t["feature"]) == F.transform("b_top_features", lambda t: t["feature"])
    agrees = ~_far("churn_probability", "b_churn_probability") & same[0] & same[1] & same[2] & names
    streamed = spark.read.parquet(f"{folder}/out")
    return streamed.join(renamed, F.col("customer_id") == F.col("b_customer_id")).select("customer_id", "model_version", agrees.alias("agrees"))
