"""Distributions of scores and columns: summaries, histograms, box plots, cross tables, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import nan_to_null, ratio_or_zero
from tidemark.functions.ranks import exact_quantiles


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Count, mean, exact median, population standard deviation, minimum and maximum of the known scores:
    NaN is missing like NULL."""
    df = nan_to_null(df.select(score))
    median = exact_quantiles(df.select(score), score, {"median": 0.5}).scalar()
    return df.agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    ).withColumn("median", median)


def risk_summary(df: DataFrame, score: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows, high-risk rows and their percentage (0 for an empty table)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(score) >= F.lit(float(threshold))).alias("n_high_risk"),
        (100 * ratio_or_zero(F.count_if(F.col(score) >= F.lit(float(threshold))), F.count(F.lit(1)))).alias(
            "high_risk_pct"
        ),
    )


def histogram(
    df: DataFrame, value: str, bins: int = 30, bounds: tuple[float, float] | None = (0.0, 1.0), by: str | None = None
) -> DataFrame:
    """(bin, bin_start, bin_end, n) for equal-width bins, empty ones included.

    ``bounds=None`` takes the observed minimum and maximum. Values on the upper bound belong to
    the last bin; values outside the bounds are not counted. With ``by`` every group present
    gets all bins; groups are expected to be classes, not keys.
    """
    values = df.select(*([by] if by else []), F.col(value).cast("double").alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan("__v")
    )
    if bounds is None:
        extent = values.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi"))).scalar()
    else:
        extent = F.struct(F.lit(float(bounds[0])).alias("lo"), F.lit(float(bounds[1])).alias("hi"))
    low, width = F.col("__x")["lo"], (F.col("__x")["hi"] - F.col("__x")["lo"]) / F.lit(float(bins))
    position = F.coalesce(F.try_divide(F.col("__v") - low, width), F.lit(0.0))
    counted = (
        values.withColumn("__x", extent)
        .where(F.col("__v").between(F.col("__x")["lo"], F.col("__x")["hi"]))
        .select(*([by] if by else []), F.least(F.floor(position), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(*([by] if by else []), "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spark = df.sparkSession
    if by:
        groups = values.select(by).distinct()
        frame = groups.select(by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        filled = frame.join(counted, (frame[by].eqNullSafe(counted[by])) & (frame["bin"] == counted["bin"]), "left")
        filled = filled.select(frame[by], frame["bin"], "n")
    else:
        frame = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        filled = frame.join(counted, "bin", "left")
    return filled.withColumn("__x", extent).select(
        *([by] if by else []),
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def five_numbers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The box-plot numbers per group, exact."""
    return exact_quantiles(df.select(*by, value), value, FIVE_NUMBERS, by)


def score_band_outcomes(df: DataFrame, score: str, label: str) -> DataFrame:
    """Counts per score band (0,.2] ... (.8,1] and outcome; a score of exactly 0 is outside."""
    # Band labels and their right-closed bounds.
    bands = [("(0.0, 0.2]", 0.0, 0.2), ("(0.2, 0.4]", 0.2, 0.4), ("(0.4, 0.6]", 0.4, 0.6), ("(0.6, 0.8]", 0.6, 0.8), ("(0.8, 1.0]", 0.8, 1.0)]
    band = F.lit(None).cast("string")
    for name, low, high in bands:
        band = F.when((F.col(score) > low) & (F.col(score) <= high), F.lit(name)).otherwise(band)
    return (
        df.select(band.alias("band"), label)
        .where(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count_if(F.col(label) == 0).alias("stayed"), F.count_if(F.col(label) == 1).alias("left"))
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, rows, missing rows, and bounds of numeric columns. One aggregation."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    stats = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        missing = c.isNull()
        numeric = isinstance(f.dataType, T.NumericType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(c)
            c = F.when(~F.isnan(c), c)
        stats.append(F.count_if(missing).alias(f"missing{i}"))
        stats.append((F.min(c) if numeric else F.lit(None)).cast("double").alias(f"min{i}"))
        stats.append((F.max(c) if numeric else F.lit(None)).cast("double").alias(f"max{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("rows").alias("n_rows"),
                F.col(f"missing{i}").alias("n_missing"),
                F.col(f"min{i}").alias("min_value"),
                F.col(f"max{i}").alias("max_value"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return df.agg(*stats).select(F.inline(rows))


def display_rows(df: DataFrame, score: str, flag_column: str, id_column: str, n: int = 20) -> DataFrame:
    """A small table for people: the first n rows by key, three decimals, yes/no."""
    return df.orderBy(id_column).limit(n).select(
        id_column,
        F.format_number(score, 3).alias("probability_text"),
        F.when(F.col(flag_column), F.lit("Yes")).otherwise(F.lit("No")).alias("high_risk_text"),
    )
