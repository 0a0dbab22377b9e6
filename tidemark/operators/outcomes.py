"""Predictions and the outcomes that arrive later.

The log and the outcome events are both append-only. The current state is a join, so recording
an outcome never rewrites the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio


def prediction_key(customer: Column, version: Column, at: Column) -> Column:
    """An id that is the same whenever the same batch is written again."""
    return F.concat_ws("_", F.lit("PRED"), customer.cast("string"), version, F.date_format(at, "yyyyMMdd_HHmmss_SSSSSS"))


def latest_outcomes(outcomes: DataFrame) -> DataFrame:
    """The last recorded outcome of each prediction; repeated ids collapse before the shuffle."""
    return outcomes.groupBy("prediction_id").agg(
        F.max(F.struct("outcome_timestamp", "actual_outcome")).alias("__last")
    ).select("prediction_id", "__last.outcome_timestamp", "__last.actual_outcome")


def current_state(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The log with outcomes attached: a later event wins over what the log row came with."""
    late = latest_outcomes(outcomes).select(
        "prediction_id", F.col("outcome_timestamp").alias("__at"), F.col("actual_outcome").alias("__outcome")
    )
    joined = log.join(late, "prediction_id", "left")
    return joined.withColumns(
        {
            "actual_outcome": F.coalesce("__outcome", "actual_outcome"),
            "outcome_timestamp": F.coalesce("__at", "outcome_timestamp"),
        }
    ).select(*log.columns)


def unmatched_outcomes(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcome events whose prediction is not in the log."""
    return outcomes.join(log.select("prediction_id"), "prediction_id", "left_anti")


def retrieve(
    log: DataFrame,
    customer_id: str | None = None,
    model_version: str | None = None,
    has_outcome: bool | None = None,
    start: object | None = None,
    end: object | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Log rows that satisfy every given condition; bounds are inclusive.

    Conditions are plain comparisons, so they reach the file scan; a log with a date partition
    column is also pruned by it. With ``limit`` the newest rows are kept, ties by id.
    """
    conditions = []
    if customer_id is not None:
        conditions.append(F.col("customer_id") == F.lit(customer_id))
    if model_version is not None:
        conditions.append(F.col("model_version") == F.lit(model_version))
    if has_outcome is not None:
        known = F.col("actual_outcome").isNotNull()
        conditions.append(known if has_outcome else ~known)
    dated = "prediction_date" in log.columns
    if start is not None:
        at = F.lit(start).cast("timestamp")
        conditions.append(F.col("prediction_timestamp") >= at)
        if dated:
            conditions.append(F.col("prediction_date") >= at.cast("date"))
    if end is not None:
        at = F.lit(end).cast("timestamp")
        conditions.append(F.col("prediction_timestamp") <= at)
        if dated:
            conditions.append(F.col("prediction_date") <= at.cast("date"))
    for c in conditions:
        log = log.where(c)
    ordered = log.orderBy(F.desc("prediction_timestamp"), "prediction_id")
    return ordered if limit is None else ordered.limit(limit)


def log_statistics(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals with and without outcome, and the accuracy where there are outcomes."""
    known = F.col("actual_outcome").isNotNull()
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(known).alias("predictions_with_outcomes"),
        F.count_if(~known).alias("predictions_without_outcomes"),
        ratio(F.count_if(F.col("predicted_class") == F.col("actual_outcome")), F.count_if(known)).alias("accuracy"),
    )
