"""Table, record and log-row checks.

Schema checks read ``df.schema`` only. Data checks share one aggregation; the row forms return
the offending rows with the reasons, so that nothing has to be brought to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.errors import TableCheckError
from tidemark.functions.columns import nan_to_null


@dataclass(frozen=True)
class TableSpec:
    """What a table must look like. Columns beyond the declared ones are tolerated."""

    required: Sequence[str]
    numeric: Sequence[str]
    categorical: Sequence[str]
    target: str | None = None
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


CUSTOMER_SPEC = TableSpec(
    required=settings.NUMERIC_FEATURES + settings.CATEGORICAL_FEATURES,
    numeric=settings.NUMERIC_FEATURES,
    categorical=settings.CATEGORICAL_FEATURES,
    target=settings.TARGET,
)


def schema_errors(df: DataFrame, spec: TableSpec, training: bool = False) -> list[str]:
    """Everything wrong with the schema, without running a job."""
    types = {f.name: f.dataType for f in df.schema.fields}
    errors = []
    missing = sorted(set(spec.required) - types.keys())
    if missing:
        errors.append(f"Missing required features: {missing}")
    if training and spec.target is None:
        errors.append("Target variable not specified")
    elif training and spec.target not in types:
        errors.append(f"Missing target variable: {spec.target}")
    for name in spec.numeric:
        if name in types and not isinstance(types[name], T.NumericType):
            errors.append(f"Feature '{name}' must be numeric, got {types[name].simpleString()}")
    for name in spec.categorical:
        if name in types and not isinstance(types[name], T.StringType):
            errors.append(f"Feature '{name}' must be categorical/string, got {types[name].simpleString()}")
    return errors


def range_report(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row per ranged column: observed bounds, rows outside, and whether the column is fine."""
    columns = [c for c in ranges if c in df.columns]
    df = nan_to_null(df.select(*columns))
    stats = []
    for i, c in enumerate(columns):
        low, high = ranges[c]
        stats += [
            F.min(c).cast("double").alias(f"min{i}"),
            F.max(c).cast("double").alias(f"max{i}"),
            F.count_if(~F.col(c).between(F.lit(low), F.lit(high))).alias(f"out{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(float(ranges[c][0])).alias("lower_bound"),
                F.lit(float(ranges[c][1])).alias("upper_bound"),
                F.col(f"min{i}").alias("observed_min"),
                F.col(f"max{i}").alias("observed_max"),
                F.col(f"out{i}").alias("n_outside"),
                (F.col(f"out{i}") == 0).alias("in_range"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*stats).select(F.inline(rows))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """The rows with a known value outside its inclusive range, and the names of those columns."""
    columns = [c for c in ranges if c in df.columns]
    bad = F.array_compact(
        F.array(
            *[
                F.when(~F.col(c).between(F.lit(ranges[c][0]), F.lit(ranges[c][1])), F.lit(c))
                for c in columns
            ]
        )
    )
    return nan_to_null(df).withColumn("out_of_range", bad).where(F.size("out_of_range") > 0)


def emptiness(df: DataFrame) -> DataFrame:
    """One row that says whether the table is empty, after a look at one row of it."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def check_table(df: DataFrame, spec: TableSpec = CUSTOMER_SPEC, training: bool = False) -> bool:
    """Raise on the first problem found, in the order: empty, schema, ranges."""
    if df.isEmpty():
        raise TableCheckError("Data is empty")
    errors = schema_errors(df, spec, training)
    if errors:
        raise TableCheckError(errors[0])
    ranged = [c for c in spec.ranges if c in df.columns]
    if ranged:
        for r in range_report(df, spec.ranges).where(~F.col("in_range")).collect():  # one row per column
            raise TableCheckError(
                f"Feature '{r.feature}' has values outside valid range "
                f"[{spec.ranges[r.feature][0]}, {spec.ranges[r.feature][1]}]. "
                f"Found range: [{r.observed_min}, {r.observed_max}]"
            )
    return True


def _missing(value: Column, data_type: T.DataType) -> Column:
    unknown = value.isNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        unknown = unknown | F.isnan(value)
    return unknown


def record_problems(
    df: DataFrame, features: Sequence[str], id_column: str = settings.ID_COLUMN, output: str = "problems"
) -> DataFrame:
    """Add the list of problems of each scoring record: blank id, or no known feature at all."""
    types = {f.name: f.dataType for f in df.schema.fields}
    all_missing = F.lit(True)
    for name in features:
        all_missing = all_missing & _missing(F.col(name), types[name])
    blank_id = F.coalesce(F.length(F.trim(F.col(id_column))) == 0, F.lit(True))
    return df.withColumn(
        output,
        F.array_compact(
            F.array(
                F.when(blank_id, F.lit("customer_id must be a non-empty string")),
                F.when(all_missing, F.lit("All feature values cannot be None/NaN")),
            )
        ),
    )


def map_record_problems(
    df: DataFrame,
    required: Sequence[str],
    id_column: str = settings.ID_COLUMN,
    map_column: str = "features",
    output: str = "problems",
) -> DataFrame:
    """The same for records that arrive as an id and a map of features."""
    feats = F.col(map_column)
    blank_id = F.coalesce(F.length(F.trim(F.col(id_column))) == 0, F.lit(True))
    no_features = F.coalesce(F.cardinality(feats) == 0, F.lit(True))
    absent = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), F.map_keys(feats)))
    all_missing = ~F.exists(F.map_values(feats), lambda v: v.isNotNull() & (F.lower(v) != "nan"))
    return df.withColumn(
        output,
        F.array_compact(
            F.array(
                F.when(blank_id, F.lit("customer_id must be a non-empty string")),
                F.when(no_features, F.lit("features must be a non-empty dictionary")),
                F.when(
                    ~no_features & (F.size(absent) > 0),
                    F.concat(F.lit("Missing required features: "), F.array_join(absent, ", ")),
                ),
                F.when(~no_features & all_missing, F.lit("All feature values cannot be None/NaN")),
            )
        ),
    )


def log_row_problems(df: DataFrame, output: str = "problems") -> DataFrame:
    """Domain checks of prediction-log rows. An unknown prediction or class is a problem too."""
    bad_score = ~F.coalesce(F.col("prediction").between(0.0, 1.0), F.lit(False))
    bad_class = ~F.coalesce(F.col("predicted_class").isin(0, 1), F.lit(False))
    bad_outcome = ~F.coalesce(F.col("actual_outcome").isin(0, 1), F.lit(True))
    return df.withColumn(
        output,
        F.array_compact(
            F.array(
                F.when(bad_score, F.lit("prediction must be between 0 and 1")),
                F.when(bad_class, F.lit("predicted class must be 0 or 1")),
                F.when(bad_outcome, F.lit("actual outcome must be 0 or 1")),
            )
        ),
    )


def split_on_problems(df: DataFrame, column: str = "problems") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    return df.where(F.size(column) == 0).drop(column), df.where(F.size(column) > 0)


def raise_on_problems(df: DataFrame, column: str = "problems") -> None:
    """Raise if any row has a problem; brings one row to the driver."""
    first = df.where(F.size(column) > 0).select(column).head()
    if first is not None:
        raise TableCheckError("; ".join(first[0]))


def check_max_rows(df: DataFrame, max_rows: int | None) -> None:
    """Optional guard for callers with a batch limit; no limit by default."""
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"Batch size exceeds maximum {max_rows}")


def pairing_gaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only. Two tables pair up exactly when this is all zeros.

    Both sides are reduced to distinct keys first, so a repeated key joins once.
    """
    a = left.select(key).distinct().withColumn("__l", F.lit(True))
    b = right.select(key).distinct().withColumn("__r", F.lit(True))
    return a.join(b, key, "full").agg(
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("n_paired"),
        F.count_if(F.col("__r").isNull()).alias("n_left_only"),
        F.count_if(F.col("__l").isNull()).alias("n_right_only"),
    )
