"""Curves over the score: ROC, empirical distribution and calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio_or_zero, right_closed_bin
from tidemark.functions.ranks import exact_quantiles, known, running_totals


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the start point with a NULL threshold.

    Each row says what share of either class scores at least the threshold.
    """
    ranked = running_totals(
        df, score, {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}, by
    )
    points = ranked.select(
        *by,
        F.col(score).cast("double").alias("threshold"),
        ratio_or_zero(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("fpr"),
        ratio_or_zero(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("tpr"),
    )
    start = [F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")]
    if by:
        first = known(df, score).select(*by).distinct().select(*by, *start)
    else:
        first = df.sparkSession.range(1).select(*start)
    return points.unionByName(first)


def empirical_cdf(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(score, share of rows at or below it) for every distinct score."""
    ranked = running_totals(df, score, {"n": F.count(F.lit(1))}, by)
    return ranked.select(
        *by, score, ratio_or_zero(F.col("n_before") + F.col("n"), F.col("n_total")).alias("cumulative_share")
    )


def calibration_curve(
    df: DataFrame, label: str, score: str, n_bins: int = 10, strategy: str = "uniform"
) -> DataFrame:
    """(bin, prob_true, prob_pred, n) for the non-empty bins.

    Bins are closed on the right. Uniform edges are i/n_bins; quantile edges are exact. Rows without a
    label or with a missing score (NULL or NaN) are left out.
    """
    if n_bins < 2:
        raise ValueError(f"n_bins must be at least 2, got {n_bins}")
    if strategy not in ("uniform", "quantile"):
        raise ValueError(f"strategy must be 'uniform' or 'quantile', got '{strategy}'")
    df = known(df.select(label, score).where(F.col(label).isNotNull()), score)
    if strategy == "uniform":
        edges = [F.lit(i * (1.0 / n_bins)) for i in range(1, n_bins)]
    else:
        probabilities = {f"e{i}": i * (1.0 / n_bins) for i in range(1, n_bins)}
        found = exact_quantiles(df, score, probabilities).select(F.array(*probabilities).alias("edges")).scalar()
        df = df.withColumn("__edges", found)
        edges = [F.get("__edges", F.lit(i)) for i in range(n_bins - 1)]
    binned = df.withColumn("bin", right_closed_bin(F.col(score), edges))
    return binned.groupBy("bin").agg(
        F.avg(label).alias("prob_true"), F.avg(score).alias("prob_pred"), F.count(F.lit(1)).alias("n")
    )


def calibration_error(curve: DataFrame) -> DataFrame:
    """Mean absolute gap over the bins (not weighted by their size) and its verdict."""
    return curve.agg(F.avg(F.abs(F.col("prob_true") - F.col("prob_pred"))).alias("calibration_error")).withColumn(
        "quality", calibration_quality(F.col("calibration_error"))
    )


def calibration_quality(error: Column) -> Column:
    return (
        F.when(error < 0.05, F.lit("well calibrated")).when(error < 0.10, F.lit("acceptable")).otherwise(F.lit("poor"))
    )
