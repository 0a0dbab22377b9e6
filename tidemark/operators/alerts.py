"""Alerts for model versions whose recall is too low."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings

METRICS = ["recall", "precision", "f1_score", "accuracy", "roc_auc"]


def alert_message(threshold: float) -> Column:
    return F.format_string(
        "Model performance degradation detected for version %s. "
        "Recall: %.4f (threshold: %.4f), Precision: %.4f, F1-Score: %.4f",
        F.col("model_version"),
        F.round("recall", 4),
        F.lit(float(threshold)),
        F.round("precision", 4),
        F.round("f1_score", 4),
    )


def alert_key(at: Column, version: Column) -> Column:
    """Unique per check and version, without a counter that tasks would have to share."""
    return F.concat_ws("_", F.lit("ALERT"), F.date_format(at, "yyyyMMdd_HHmmss"), version)


def raise_alerts(
    evaluations: DataFrame,
    threshold: float = settings.MIN_RECALL,
    alert_type: str = "performance_degradation",
    severity: str = "high",
) -> DataFrame:
    """One alert per evaluation row below the threshold, dated like the evaluation."""
    entries = [x for m in METRICS if m in evaluations.columns for x in (F.lit(m), F.col(m))]
    return evaluations.where(F.col("recall") < F.lit(float(threshold))).select(
        alert_key(F.col("evaluation_date"), F.col("model_version")).alias("alert_id"),
        "model_version",
        F.lit(alert_type).alias("alert_type"),
        alert_message(threshold).alias("message"),
        F.col("evaluation_date").alias("timestamp"),
        F.lit(severity).alias("severity"),
        F.create_map(*entries).alias("metrics"),
    )


def newest_alerts(alerts: DataFrame, model_version: str | None = None, limit: int | None = None) -> DataFrame:
    if model_version is not None:
        alerts = alerts.where(F.col("model_version") == F.lit(model_version))
    ordered = alerts.orderBy(F.desc("timestamp"), "alert_id")
    return ordered if limit is None else ordered.limit(limit)
