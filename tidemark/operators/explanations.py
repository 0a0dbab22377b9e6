"""Reports over attributions: an ``array<double>`` per row, in the order of the feature names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.settings import ID_COLUMN, TOP_FEATURES


def top_features(values: Column, names: Sequence[str], n: int = TOP_FEATURES) -> Column:
    """The n largest attributions by magnitude as (feature, shap_value), ties in feature order.

    Sorting happens inside the row: no shuffle and no join.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    listed = F.array(*[F.lit(name) for name in names])
    keyed = F.transform(values, lambda v, i: F.struct((-F.abs(v)).alias("order"), i.alias("at"), v.alias("value")))
    return F.transform(
        F.slice(F.array_sort(keyed), 1, n),
        lambda s: F.struct(F.element_at(listed, s["at"] + 1).alias("feature"), s["value"].alias("shap_value")),
    )


def additivity_error(values: Column, base: Column, predicted: Column) -> Column:
    """Distance between the sum of the attributions and the prediction's lead over the base value."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.abs(total - (predicted - base))


def additivity_check(
    df: DataFrame, values: str, base: str, predicted: str, tolerance: float = 0.001
) -> DataFrame:
    """(n_rows, n_violations, max_error)."""
    error = additivity_error(F.col(values), F.col(base), F.col(predicted))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(error > F.lit(float(tolerance))).alias("n_violations"),
        F.max(error).alias("max_error"),
    )


def _named(df: DataFrame, arrays: dict[str, Column], names: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """One row per feature from one-row arrays of per-feature numbers."""
    listed = F.array(*[F.lit(n) for n in names]).alias("feature")
    zipped = F.arrays_zip(listed, *[c.alias(n) for n, c in arrays.items()])
    return df.select(*keep, F.inline(zipped))


def mean_magnitude(df: DataFrame, values: str, names: Sequence[str], top: int | None = 10) -> DataFrame:
    """(feature, importance): mean absolute attribution over all rows, largest first.

    The vector summarizer sums magnitudes per task, so rows are not exploded.
    """
    summary = Summarizer.metrics("normL1", "count").summary(array_to_vector(F.col(values)))
    one = df.agg(summary.alias("s")).select(
        F.transform(vector_to_array("s.normL1"), lambda v: v / F.col("s.count")).alias("importance")
    )
    ranked = _named(one, {"importance": F.col("importance")}, names).orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)


def top_feature_importance(df: DataFrame, column: str = "top_features", top: int = 10) -> DataFrame:
    """(feature, importance, n_rows): mean magnitude over the rows that list the feature."""
    return (
        df.select(F.inline(column))
        .groupBy("feature")
        .agg(F.avg(F.abs("shap_value")).alias("importance"), F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )


def risk_group_difference(df: DataFrame, values: str, high_risk: str, names: Sequence[str]) -> DataFrame:
    """(feature, high_risk_mean, low_risk_mean, difference); no rows unless both groups exist."""
    means = df.where(F.col(high_risk).isNotNull()).groupBy(high_risk).agg(
        vector_to_array(Summarizer.mean(array_to_vector(F.col(values)))).alias("mean")
    )
    both = means.agg(
        F.max(F.when(F.col(high_risk), F.col("mean"))).alias("high"),
        F.max(F.when(~F.col(high_risk), F.col("mean"))).alias("low"),
    ).where(F.col("high").isNotNull() & F.col("low").isNotNull())
    named = _named(both, {"high_risk_mean": F.col("high"), "low_risk_mean": F.col("low")}, names)
    return named.withColumn("difference", F.col("high_risk_mean") - F.col("low_risk_mean")).orderBy(
        F.desc("difference"), "feature"
    )


def impact(value: Column) -> Column:
    return F.when(value > 0, F.lit("Increases")).otherwise(F.lit("Decreases"))


def with_raw_values(
    explained: DataFrame, raw: DataFrame, key: str = ID_COLUMN, column: str = "top_features"
) -> DataFrame:
    """(key, feature, feature_value, shap_value, impact) of each top feature that is a raw column.

    The raw columns are packed into one map per row, so the tables meet in a single join on the
    key and features are looked up inside the row.
    """
    names = [c for c in raw.columns if c != key]
    entries = [x for c in names for x in (F.lit(c), F.col(c).cast("string"))]
    packed = raw.select(key, F.create_map(*entries).alias("__raw"))
    known = F.array(*[F.lit(c) for c in names])
    return (
        explained.select(key, column)
        .join(packed, key)
        .select(key, "__raw", F.inline(F.filter(column, lambda s: F.array_contains(known, s["feature"]))))
        .select(
            key,
            "feature",
            F.element_at("__raw", F.col("feature")).alias("feature_value"),
            "shap_value",
            impact(F.col("shap_value")).alias("impact"),
        )
    )


def attach_explanations(predictions: DataFrame, explained: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """All predictions, with top features where they were computed."""
    return predictions.join(explained.select(key, "top_features"), key, "left")


def attach_labels(predictions: DataFrame, labels: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Predictions with the actual label of the same customer."""
    return predictions.join(labels, key)
