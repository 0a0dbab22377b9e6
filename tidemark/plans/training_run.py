"""The training run and the end-to-end run."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.operators.classification import evaluate
from tidemark.operators.explanations import attach_explanations, attach_labels
from tidemark.operators.sampling import sample_rows, stratified_split, train_and_test
from tidemark.operators.scoring import predict, score
from tidemark.operators.training import AttritionModel, train
from tidemark.operators.validation import CUSTOMER_SPEC, check_table
from tidemark.sources.prediction_log import PredictionLog
from tidemark.sources.registry import ModelRegistry

METRICS = ["precision", "recall", "f1_score", "accuracy", "roc_auc"]


def check_recall(metrics: Mapping[str, Any], threshold: float = settings.MIN_RECALL, on_fail: str = "raise") -> bool:
    """The recall gate: raise, or warn and return False."""
    if metrics["recall"] >= threshold:
        return True
    message = f"Model does not meet minimum recall requirement. Got {metrics['recall']:.4f}, required {threshold:.4f}"
    if on_fail == "raise":
        raise ValueError(message)
    warnings.warn(message, stacklevel=2)
    return False


def evaluate_model(model: AttritionModel, test: DataFrame) -> dict[str, Any]:
    """The evaluation row of a model on labelled customers, as a dictionary."""
    scored = score(model, test, [settings.TARGET])
    row = evaluate(scored, settings.TARGET, "churn_probability", "predicted_class", by=[]).first()
    return row.asDict()


def training_run(
    customers: DataFrame,
    registry: ModelRegistry,
    params: Mapping[str, Any] | None = None,
    version: str | None = None,
    threshold: float = settings.MIN_RECALL,
    on_fail: str = "raise",
) -> tuple[str, AttritionModel, dict[str, Any]]:
    """Check, split, train, evaluate on the held-out part, pass the recall gate, save."""
    check_table(customers, CUSTOMER_SPEC, training=True)
    train_part, test_part = train_and_test(stratified_split(customers, settings.TARGET))
    model = train(train_part, params=params)
    metrics = evaluate_model(model, test_part)
    check_recall(metrics, threshold, on_fail)
    version = registry.save(model, version, {"metrics": {m: metrics[m] for m in METRICS}})
    return version, model, metrics


@dataclass(frozen=True)
class RunResult:
    version: str
    training_metrics: dict[str, Any]
    predictions: DataFrame
    explained: DataFrame
    evaluation: DataFrame


def full_run(
    spark: SparkSession,
    train_customers: DataFrame,
    test_customers: DataFrame,
    registry: ModelRegistry,
    log: PredictionLog,
    scored_at: Column,
    params: Mapping[str, Any] | None = None,
    explain_rows: int | None = 100,
    version: str | None = None,
) -> RunResult:
    """Both tables checked, a model trained and saved, reloaded, applied to the test table,
    explained for a sample (``None`` explains all), logged with outcomes and evaluated."""
    check_table(train_customers, CUSTOMER_SPEC, training=True)
    check_table(test_customers, CUSTOMER_SPEC, training=True)
    trained = train(train_customers, params=params)
    metrics = evaluate_model(trained, test_customers)
    check_recall(metrics, on_fail="warn")
    version = registry.save(trained, version, {"metrics": {m: metrics[m] for m in METRICS}})

    _, model = registry.load(version)
    labels = test_customers.select(settings.ID_COLUMN, F.col(settings.TARGET).alias("actual_outcome"))
    predictions = attach_labels(predict(model, test_customers, version, scored_at).drop("top_features"), labels)

    chosen = test_customers if explain_rows is None else sample_rows(test_customers, explain_rows)
    explained = attach_explanations(
        predictions.join(chosen.select(settings.ID_COLUMN), settings.ID_COLUMN, "left_semi"),
        predict(model, chosen, version, scored_at, leaves=registry.leaves(version), explain=True),
    )

    log.append(
        predictions.select(
            settings.ID_COLUMN,
            "model_version",
            F.col("churn_probability").alias("prediction"),
            F.col("is_high_risk").cast("int").alias("predicted_class"),
            "actual_outcome",
        ),
        scored_at,
    )
    logged = log.current().where(F.col("model_version") == version)
    evaluation = evaluate(logged, "actual_outcome", "prediction", "predicted_class")
    return RunResult(version, metrics, predictions, explained, evaluation)
