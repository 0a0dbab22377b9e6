"""Attaching outcomes that arrive after the prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def attach_outcomes(
    predictions: DataFrame, outcomes: DataFrame, within: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Left outer join of two streams on the prediction id.

    An outcome counts if it comes at most ``within`` after its prediction. The bound and the
    watermarks let Spark drop old state: a prediction is held for ``within`` plus ``delay`` and
    then emitted without an outcome. Later outcomes belong in the log's outcome events, which
    the batch view joins without a time limit.
    """
    p = predictions.withWatermark("prediction_timestamp", delay)
    o = outcomes.select(
        F.col("prediction_id").alias("__id"), "actual_outcome", "outcome_timestamp"
    ).withWatermark("outcome_timestamp", delay)
    condition = (
        (F.col("prediction_id") == F.col("__id"))
        & (F.col("outcome_timestamp") >= F.col("prediction_timestamp"))
        & (F.col("outcome_timestamp") <= F.col("prediction_timestamp") + F.expr(f"INTERVAL {within}"))
    )
    return p.join(o, condition, "left_outer").drop("__id")


def latest_attached(attached: DataFrame) -> DataFrame:
    """One row for every prediction that the stream emitted, with its latest outcome within the bound or none."""
    last = F.max(F.struct("outcome_timestamp", "actual_outcome")).alias("last")
    return attached.groupBy("prediction_id").agg(last).select("prediction_id", "last.actual_outcome", "last.outcome_timestamp")


def latest_outcomes(
    predictions: DataFrame, outcomes: DataFrame, within: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """A stream with one row for every prediction whose time is up: its latest outcome within the bound, or none.

    Two stateful operators in a row: the outer join, and a maximum per prediction, whose state is one row for each
    open one. The watermark reaches the second behind the first, later by ``within``: a prediction comes out when no
    outcome that counts can still arrive. Of outcomes of one moment the greater counts.
    """
    attached = attach_outcomes(predictions, outcomes, within, delay)
    # one event time goes on, that of the prediction
    decided_at = F.timestamp_micros(F.unix_micros("outcome_timestamp")).alias("outcome_timestamp")
    key = ["prediction_id", "prediction_timestamp"]
    rest = [c for c in predictions.columns if c not in key]
    closed = attached.groupBy(*key).agg(
        F.max(F.struct(decided_at, "actual_outcome")).alias("last"), *[F.any_value(c).alias(c) for c in rest]
    )
    return closed.select(*predictions.columns, "last.actual_outcome", "last.outcome_timestamp")


def outcomes_out_of_time(outcomes: DataFrame, closed: DataFrame, within: str = "1 day") -> DataFrame:
    """Outcome events of closed predictions that came before the prediction or after its time was up."""
    p = closed.select(F.col("prediction_id").alias("__id"), "prediction_timestamp")
    begin, end = F.col("prediction_timestamp"), F.col("prediction_timestamp") + F.expr(f"INTERVAL {within}")
    found = outcomes.join(p, F.col("prediction_id") == F.col("__id"))
    return found.where(~F.col("outcome_timestamp").between(begin, end)).select(*outcomes.columns)


def late_outcomes(outcomes: DataFrame, attached: DataFrame) -> DataFrame:
    """Outcome events of a finished period that the stream did not attach."""
    done = attached.where(F.col("outcome_timestamp").isNotNull()).select("prediction_id", "outcome_timestamp")
    return outcomes.join(done, ["prediction_id", "outcome_timestamp"], "left_anti")


def write_attached(attached: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    return (
        attached.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
