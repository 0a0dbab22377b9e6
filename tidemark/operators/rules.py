"""Rule-table constraint checks over hyper-parameter configurations in long form.

Input rows are ``(config_id, param, value, value_type)`` with the value as text and its type as
one of ``int``, ``float``, ``str`` or ``bool``. One row per rule sits in a small constant table,
so a grid of any size is checked by one broadcast join without a shuffle.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ParameterError

# Fixed values. Numeric rules: name, kind, lower bound, lower bound is excluded, upper bound, text.
NUMERIC_RULES = [
    ("learning_rate", "number", 0.0, True, 1.0, "Learning rate (eta) must be in range (0, 1]"),
    ("max_depth", "int", 0.0, False, None, "Maximum tree depth must be >= 0"),
    ("n_estimators", "int", 1.0, False, None, "Number of estimators must be >= 1"),
    ("subsample", "number", 0.0, True, 1.0, "Subsample ratio must be in range (0, 1]"),
    ("colsample_bytree", "number", 0.0, True, 1.0, "Column sample by tree must be in range (0, 1]"),
    ("colsample_bylevel", "number", 0.0, True, 1.0, "Column sample by level must be in range (0, 1]"),
    ("colsample_bynode", "number", 0.0, True, 1.0, "Column sample by node must be in range (0, 1]"),
    ("min_child_weight", "number", 0.0, False, None, "Minimum child weight must be >= 0"),
    ("gamma", "number", 0.0, False, None, "Gamma (min split loss) must be >= 0"),
    ("reg_alpha", "number", 0.0, False, None, "L1 regularization (alpha) must be >= 0"),
    ("reg_lambda", "number", 0.0, False, None, "L2 regularization (lambda) must be >= 0"),
    ("scale_pos_weight", "number", 0.0, True, None, "Scale positive weight must be > 0"),
    ("max_delta_step", "number", 0.0, False, None, "Max delta step must be >= 0"),
    ("random_state", "int", None, False, None, "Random state must be an integer"),
]

# Fixed values. Enumerations: name, allowed values.
ENUM_RULES = {
    "objective": [
        "reg:squarederror", "reg:squaredlogerror", "reg:logistic", "reg:pseudohubererror", "binary:logistic",
        "binary:logitraw", "binary:hinge", "count:poisson", "survival:cox", "survival:aft", "multi:softmax",
        "multi:softprob", "rank:pairwise", "rank:ndcg", "rank:map", "reg:gamma", "reg:tweedie",
    ],
    "booster": ["gbtree", "gblinear", "dart"],
    "tree_method": ["auto", "exact", "approx", "hist", "gpu_hist"],
    "grow_policy": ["depthwise", "lossguide"],
    "eval_metric": [
        "rmse", "rmsle", "mae", "mape", "mphe", "logloss", "error", "error@t", "merror", "mlogloss", "auc",
        "aucpr", "ndcg", "map", "ndcg@n", "map@n", "poisson-nloglik", "gamma-nloglik", "cox-nloglik",
        "gamma-deviance", "tweedie-nloglik",
    ],
    "sampling_method": ["uniform", "gradient_based"],
    "multi_strategy": ["one_output_per_tree", "multi_output_tree"],
}

RULE_SCHEMA = T.StructType(
    [
        T.StructField("param", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("lower", T.DoubleType()),
        T.StructField("lower_excluded", T.BooleanType()),
        T.StructField("upper", T.DoubleType()),
        T.StructField("allowed", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
    ]
)


def rule_rows() -> list[tuple]:
    """One row of RULE_SCHEMA per parameter."""
    rows = [(n, k, lo, ex, hi, None, text) for n, k, lo, ex, hi, text in NUMERIC_RULES]
    return rows + [(n, "enum", None, False, None, allowed, "Must be one of: " + ", ".join(allowed)) for n, allowed in ENUM_RULES.items()]


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as a table."""
    return spark.createDataFrame(rule_rows(), RULE_SCHEMA)


def rule_violations(configs: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(config_id, param, value, error) for every broken rule.

    Unknown parameters and NULL values pass. Booleans pass as integers, and a NaN passes the
    range tests, because every comparison with it is false.
    """
    return _messages(_checked(configs, rules).where(F.col("__broken").isNotNull()))


def with_errors(configs: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(config_id, param, value, error) for every row, with a NULL error where nothing is broken."""
    return _messages(_checked(configs, rules))


def _checked(configs: DataFrame, rules: DataFrame | None) -> DataFrame:
    """The rows with their rule and ``__broken``: what is wrong (name, type or range), or NULL. The text of the error is
    made by ``_messages``, once, and only for rows that are left then."""
    constant = rules is None
    rules = rule_table(configs.sparkSession) if constant else rules
    # the built-in table has 21 rows; one given by the caller is left to the optimizer
    known = configs.join(F.broadcast(rules) if constant else rules, "param", "left")
    is_bool = F.col("value_type") == "bool"
    number = F.when(is_bool, F.lower("value").eqNullSafe("true").cast("double")).otherwise(
        F.col("value").try_cast("double")
    )
    typed = F.when(F.col("kind") == "int", F.col("value_type").isin("int", "bool")).otherwise(
        F.col("value_type").isin("int", "float", "bool")
    )
    # Spark orders NaN above every number, so it has to be exempted by hand
    comparable = ~F.isnan(number)
    too_low = comparable & F.when(F.col("lower_excluded"), number <= F.col("lower")).otherwise(
        number < F.col("lower")
    )
    too_high = comparable & (number > F.col("upper"))
    beyond = F.coalesce(too_low, F.lit(False)) | F.coalesce(too_high, F.lit(False))
    broken = F.when(F.col("kind") == "enum", F.when(~F.array_contains("allowed", F.col("value")), "name")).otherwise(
        F.when(~typed, "type").when(beyond, "range")
    )
    applies = F.col("value").isNotNull() & F.col("kind").isNotNull()
    return known.withColumn("__broken", F.when(applies, broken))


def _messages(checked: DataFrame) -> DataFrame:
    text = F.coalesce("description", F.lit("null"))
    wanted = F.when(F.col("kind") == "int", "an integer").otherwise("a number")
    error = (
        F.when(F.col("__broken") == "name", F.concat("param", F.lit(": Invalid value '"), "value", F.lit("'. "), text))
        .when(F.col("__broken") == "type", F.concat("param", F.lit(": Expected "), wanted, F.lit(", got "), "value_type"))
        .when(F.col("__broken") == "range", F.concat("param", F.lit(": "), text, F.lit(" (got "), "value", F.lit(")")))
    )
    return checked.select("config_id", "param", "value", error.alias("error"))


def violations_per_config(configs: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(config_id, n_errors, errors): all configurations, the clean ones with an empty list.

    Errors of one configuration are bounded by the number of rules.
    """
    errors = F.array_sort(F.collect_set("error")).alias("errors")  # NULLs are not collected
    listed = with_errors(configs, rules).groupBy("config_id").agg(errors)
    return listed.select("config_id", F.size("errors").alias("n_errors"), "errors")


def _type_name(value: Any) -> str:
    return {bool: "bool", int: "int", float: "float", str: "str"}.get(type(value), type(value).__name__)


def check_params(params: Mapping[str, Any]) -> bool:
    """Check one configuration held on the driver; raise with all errors at once."""
    errors = param_errors(params)
    if errors:
        raise ParameterError("Parameter validation failed:\n" + "\n".join(f"  - {e}" for e in errors))
    return True


Test = tuple[Callable[[Any], bool], Callable[[Any], str]]  # whether a value is wrong, and what to say then


def _tests_of(name: str, kind: str, lower: float | None, excluded: bool, upper: float | None, allowed: list[str] | None, text: str) -> list[Test]:
    """A row of the rule table as tests, of which the first that finds a value wrong counts."""
    if kind == "enum":
        return [(lambda v: v not in allowed, lambda v: f"{name}: Invalid value '{v}'. {text}")]
    types, wanted = (int, "an integer") if kind == "int" else ((int, float), "a number")
    tests: list[Test] = [(lambda v: not isinstance(v, types), lambda v: f"{name}: Expected {wanted}, got {_type_name(v)}")]
    # comparisons with NaN are false, so that it passes
    if lower is not None:
        beyond = operator.le if excluded else operator.lt
        tests.append((lambda v: beyond(v, lower), lambda v: f"{name}: {text} (got {v})"))
    if upper is not None:
        tests.append((lambda v: v > upper, lambda v: f"{name}: {text} (got {v})"))
    return tests


def param_errors(params: Mapping[str, Any]) -> list[str]:
    """The errors of one configuration, without a Spark job, from the rows of the rule table."""
    if not isinstance(params, Mapping):
        return ["Parameters must be a dictionary"]
    tests = {row[0]: _tests_of(*row) for row in rule_rows()}
    given = ((name, value) for name, value in params.items() if value is not None)
    found = (next((say(value) for wrong, say in tests.get(name, ()) if wrong(value)), None) for name, value in given)
    return [error for error in found if error is not None]


def to_long(spark: SparkSession, configs: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Configurations held on the driver in the long form that ``rule_violations`` takes."""
    rows = [
        (str(c), p, None if v is None else str(v), _type_name(v)) for c, ps in configs.items() for p, v in ps.items()
    ]
    return spark.createDataFrame(rows, "config_id string, param string, value string, value_type string")
