"""The scheduled performance check as a windowed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import settings
from tidemark.operators.alerts import raise_alerts
from tidemark.operators.classification import confusion_counts, evaluate_score_counts, score_counts, with_metrics
from tidemark.sources.alert_log import ALERT_SCHEMA


def windowed_counts(
    outcomes: DataFrame, every: str = "1 day", delay: str = "1 hour", score: str | None = None
) -> DataFrame:
    """Confusion counts per tumbling window of the outcome time and model version, and per distinct score if one is named.

    The state is four numbers per open window and version, however many rows arrive; with scores, seven numbers
    per distinct score in the window, which is what an exact AUC has to know. All rows of a window come out together.
    """
    timed = outcomes.withWatermark("outcome_timestamp", delay).withColumn(
        "period", F.window("outcome_timestamp", every)
    )
    by = ["period", "model_version"]
    if score is None:
        return confusion_counts(timed, "actual_outcome", "predicted_class", by)
    return score_counts(timed, "actual_outcome", score, "predicted_class", by)


def evaluation_of_window(counts: DataFrame) -> DataFrame:
    """The counts with metrics, dated by the end of their window; with an AUC if the counts are per score."""
    scored = "__score" in counts.columns
    rows = evaluate_score_counts(counts, ["period", "model_version"]) if scored else with_metrics(counts)
    return rows.select(
        "model_version",
        F.col("period.start").alias("period_start"),
        F.col("period.end").alias("evaluation_date"),
        "tn", "fp", "fn", "tp", "precision", "recall", "f1_score", "accuracy", "n_samples",
        *(["roc_auc", "n_unscored"] if scored else []),
    )


def watch_performance(
    outcomes: DataFrame,
    evaluations_path: str,
    alerts_path: str,
    checkpoint: str,
    threshold: float = settings.MIN_RECALL,
    every: str = "1 day",
    delay: str = "1 hour",
    score: str | None = "prediction",
) -> StreamingQuery:
    """Write the evaluation of every closed window and an alert for each that is too low.

    With the ``score`` column the evaluation has an exact AUC; a table without the column is evaluated without one. Each
    micro-batch overwrites its own folder, so a batch that is replayed after a failure leaves one copy of its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.persist()  # the ranks of the AUC read it twice
        rows = evaluation_of_window(counts).persist()  # a few rows per window, read by both sinks
        try:
            rows.write.mode("overwrite").parquet(f"{evaluations_path}/batch_id={batch_id}")
            raise_alerts(rows, threshold).select(*ALERT_SCHEMA.names).write.mode("overwrite").option(
                "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
            ).json(f"{alerts_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()
            counts.unpersist()

    return (
        windowed_counts(outcomes, every, delay, score if score in outcomes.columns else None)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
