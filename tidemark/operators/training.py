"""Training a boosted-tree classifier as one persistable chain of native ML stages."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.errors import ParameterError
from tidemark.functions.columns import nan_to_null, sql_double
from tidemark.operators.classification import positive_weight
from tidemark.operators.encoding import FittedEncoder, fit_encoder, route_columns
from tidemark.operators.features import add_features, derived_expressions, fit_median_charge
from tidemark.operators.rules import check_params
from tidemark.sources.scratch import shared_folder, written

UNMAPPED = {
    "reg_alpha", "reg_lambda", "colsample_bylevel", "colsample_bynode", "max_delta_step", "tree_method",
    "eval_metric", "grow_policy", "sampling_method", "multi_strategy",
}
ONLY = {"objective": "binary:logistic", "booster": "gbtree"}
DEEPEST = 30  # levels that the library's trees can have


def classifier_settings(params: Mapping[str, Any]) -> dict[str, Any]:
    """Translate the familiar boosting parameters into those of the ML classifier.

    Column sampling is per node and ``min_child_weight`` and ``gamma`` are approximations.
    Regularisation has no counterpart and is accepted with a warning. What the library cannot do is
    refused: another objective or booster, and depths over 30 or without a limit (0).
    """
    out: dict[str, Any] = {}
    given = {k: v for k, v in params.items() if v is not None}
    for name, value in ONLY.items():
        if given.get(name, value) != value:
            raise ParameterError(f"{name}: only '{value}' is supported, got '{given[name]}'")
    if "max_depth" in given:
        if not 1 <= given["max_depth"] <= DEEPEST:
            raise ParameterError(f"max_depth: only 1 to {DEEPEST} is supported, got {given['max_depth']}")
        out["maxDepth"] = int(given["max_depth"])
    if "learning_rate" in given:
        out["stepSize"] = float(given["learning_rate"])
    if "n_estimators" in given:
        out["maxIter"] = int(given["n_estimators"])
    if "subsample" in given:
        out["subsamplingRate"] = float(given["subsample"])
    if "colsample_bytree" in given:
        share = float(given["colsample_bytree"])
        out["featureSubsetStrategy"] = "all" if share == 1.0 else str(share)
    if "min_child_weight" in given:
        out["minInstancesPerNode"] = max(1, math.ceil(given["min_child_weight"]))
    if "gamma" in given:
        out["minInfoGain"] = float(given["gamma"])
    if "random_state" in given:
        out["seed"] = int(given["random_state"])
    ignored = sorted(k for k in given.keys() & UNMAPPED if given[k])
    if ignored:
        warnings.warn(f"no counterpart for {ignored}; they have no effect", stacklevel=2)
    return out


def with_weight(df: DataFrame, label: str, positive: float, output: str = "__weight") -> DataFrame:
    """Row weight: the given one for positives, 1 for the rest."""
    return df.withColumn(output, F.when(F.col(label) == 1, F.lit(float(positive))).otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class AttritionModel:
    """A fitted chain from raw customer columns to probabilities."""

    chain: PipelineModel
    encoder: FittedEncoder
    params: dict[str, Any]
    monthly_median: float | None

    @property
    def classifier(self) -> GBTClassificationModel:
        return self.chain.stages[-1]

    @property
    def feature_names(self) -> list[str]:
        return self.encoder.feature_names


def fit_classifier(df: DataFrame, label: str, params: Mapping[str, Any]) -> GBTClassificationModel:
    """Fit on a table with a ``features`` vector and a 0/1 label."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():  # noqa: SLF001
        # the lineage of the boosted residuals is cut there every ten trees
        context.setCheckpointDir(shared_folder(df.sparkSession))
    weight = params.get("scale_pos_weight")
    weighted = with_weight(df, label, 1.0 if weight is None else weight)
    classifier = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="__weight", checkpointInterval=10,
        **classifier_settings(params),
    )
    return classifier.fit(weighted.select("features", F.col(label).cast("double").alias(label), "__weight"))


def train(
    df: DataFrame,
    label: str = settings.TARGET,
    params: Mapping[str, Any] | None = None,
    balance: bool = True,
) -> AttritionModel:
    """Fit features, encoder and classifier on labelled customers.

    ``balance`` sets the positive-class weight from the class counts, as (negatives /
    positives) x boost; without positives the given weight stays.
    """
    params = dict(settings.DEFAULT_PARAMS if params is None else params)
    check_params(params)
    features = [c for c in settings.NUMERIC_FEATURES + settings.CATEGORICAL_FEATURES if c in df.columns]
    # six jobs read the training columns; as files they survive lost executors and keep plans short
    with written(nan_to_null(df.select(*features, label)).where(F.col(label).isNotNull()), "training") as data:
        return _train(data, features, label, params, balance)


def _train(data: DataFrame, features: list[str], label: str, params: dict[str, Any], balance: bool) -> AttritionModel:
    spark = data.sparkSession
    counts = positive_weight(data, label).first()
    if counts.n_negative + counts.n_positive == 0:
        raise ValueError("Training data is empty")
    if balance and counts.scale_pos_weight is not None:
        params["scale_pos_weight"] = counts.scale_pos_weight

    median = fit_median_charge(data) if "monthly_charges" in features else None
    engineered = add_features(data, monthly_median=median)
    numeric, categorical = route_columns(engineered, exclude=[label])
    encoder = fit_encoder(engineered, numeric, categorical)

    derived = derived_expressions(features, None if median is None else sql_double(median))
    listed = ", ".join(["*"] + [f"{e} AS {n}" for n, e in derived.items()])
    stages = [SQLTransformer(statement=f"SELECT {listed} FROM __THIS__"), *encoder.stages(spark)]
    encoded = PipelineModel(stages).transform(data)
    model = fit_classifier(encoded, label, params)
    return AttritionModel(PipelineModel([*stages, model]), encoder, params, median)


def feature_importance(spark: SparkSession, model: AttritionModel, top: int = 10) -> DataFrame:
    """(feature, importance): gain importance of the trees, largest first."""
    gains = model.classifier.featureImportances.toArray()
    rows = [(name, float(gain)) for name, gain in zip(model.feature_names, gains)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)
