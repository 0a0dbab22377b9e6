"""Scoring customers with a trained model: one narrow pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.functions.columns import nan_to_null
from tidemark.operators.attribution import LeafTable, attribution_udf, margin
from tidemark.operators.classification import evaluate
from tidemark.operators.explanations import top_features
from tidemark.operators.scorecard import high_risk
from tidemark.operators.training import AttritionModel
from tidemark.operators.validation import (
    CUSTOMER_SPEC,
    check_max_rows,
    raise_on_problems,
    record_problems,
    schema_errors,
)
from tidemark.errors import TableCheckError

FEATURES = settings.NUMERIC_FEATURES + settings.CATEGORICAL_FEATURES


def score(model: AttritionModel, df: DataFrame, keep: Sequence[str] = (settings.ID_COLUMN,)) -> DataFrame:
    """The kept columns with ``churn_probability``, ``predicted_class``, ``margin`` and the encoded
    ``feature_values``. The schema is checked; no job runs."""
    errors = schema_errors(df, CUSTOMER_SPEC)
    if errors:
        raise TableCheckError(errors[0])
    keep = [c for c in keep if c in df.columns]
    inputs = nan_to_null(df.select(*dict.fromkeys([*keep, *FEATURES])))
    return model.chain.transform(inputs).select(
        *keep,
        vector_to_array("probability")[1].alias("churn_probability"),
        F.col("prediction").cast("int").alias("predicted_class"),
        margin(vector_to_array("rawPrediction")).alias("margin"),
        vector_to_array("features").alias("feature_values"),
    )


def predict(
    model: AttritionModel,
    df: DataFrame,
    version: str,
    scored_at: Column,
    threshold: float = settings.HIGH_RISK_THRESHOLD,
    leaves: LeafTable | None = None,
    explain: bool = False,
    check: bool = False,
    max_rows: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The result table: id, probability, risk flag, timestamp, version and top features.

    ``check`` first looks for blank ids and records without any known feature (one more job).
    ``explain`` needs the model's leaf table; without it ``top_features`` is NULL.
    """
    if explain and leaves is None:
        raise ValueError("Explanations requested without a leaf table; build one from the model first")
    check_max_rows(df, max_rows)
    if check:
        raise_on_problems(record_problems(df, [c for c in FEATURES if c in df.columns]))
    scored = score(model, df, [settings.ID_COLUMN, *keep])
    if explain:
        attribute = attribution_udf(df.sparkSession, leaves)
        scored = scored.withColumn("__shap", attribute("feature_values"))
        top = top_features(F.col("__shap"), model.feature_names)
    else:
        top = F.lit(None).cast("array<struct<feature:string,shap_value:double>>")
    return scored.select(
        settings.ID_COLUMN,
        *keep,
        "churn_probability",
        high_risk(F.col("churn_probability"), threshold).alias("is_high_risk"),
        scored_at.alias("prediction_timestamp"),
        F.lit(version).alias("model_version"),
        top.alias("top_features"),
    )


def explain_table(model: AttritionModel, leaves: LeafTable, df: DataFrame) -> DataFrame:
    """(customer_id, shap, base_value, margin, churn_probability) for every row."""
    attribute = attribution_udf(df.sparkSession, leaves)
    return score(model, df).select(
        settings.ID_COLUMN,
        attribute("feature_values").alias("shap"),
        F.lit(leaves.base).alias("base_value"),
        "margin",
        "churn_probability",
    )


def records_table(spark: SparkSession, records: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Records held by the caller as a customer table (absent features become NULL)."""
    for r in records:
        if settings.ID_COLUMN not in r:
            raise TableCheckError("Each customer record must have 'customer_id'")
        missing = sorted(set(FEATURES) - set(r))
        if missing:
            raise TableCheckError(f"Missing required features: {missing}")
    fields = [f for f in settings.CUSTOMER_SCHEMA.fields if f.name != settings.TARGET]

    def cell(value: Any, kind: str) -> Any:
        if value is None or (isinstance(value, float) and value != value):
            return None
        return {"int": int, "double": float}.get(kind, str)(value)

    rows = [tuple(cell(r.get(f.name), f.dataType.simpleString()) for f in fields) for r in records]
    return spark.createDataFrame(rows, type(settings.CUSTOMER_SCHEMA)(fields))


def _typed_record(map_column: str) -> list[tuple[str, Column, Column]]:
    """(feature, its text or NULL where blank, its value or NULL where unreadable) for every feature."""
    out = []
    for f in settings.CUSTOMER_SCHEMA.fields:
        if f.name in FEATURES:
            text = F.nullif(F.trim(F.col(map_column)[f.name]), F.lit(""))
            out.append((f.name, text, text.try_cast(f.dataType)))
    return out


def unreadable_records(df: DataFrame, id_column: str = settings.ID_COLUMN, map_column: str = "features") -> DataFrame:
    """(customer_id, feature, text) for every feature whose text is not of the feature's type."""
    wrong = [
        F.when(text.isNotNull() & value.isNull(), F.struct(F.lit(name).alias("feature"), text.alias("text")))
        for name, text, value in _typed_record(map_column)
    ]
    return df.select(F.col(id_column).alias(settings.ID_COLUMN), F.inline(F.array_compact(F.array(*wrong))))


def records_from_maps(
    df: DataFrame, id_column: str = settings.ID_COLUMN, map_column: str = "features", on_unreadable: str = "raise"
) -> DataFrame:
    """A table of (id, map of text features) as typed customer columns. Blank text is NULL. Text that is not of its feature's
    type stops the query, or becomes NULL, and is imputed like a gap, with ``on_unreadable='null'``."""
    if on_unreadable not in ("raise", "null"):
        raise ValueError("on_unreadable must be 'raise' or 'null'")
    columns = []
    for name, text, value in _typed_record(map_column):
        if on_unreadable == "raise":
            message = F.concat(F.lit(f"Feature '{name}' cannot be read from '"), text, F.lit("'"))
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)
        columns.append(value.alias(name))
    return df.select(F.col(id_column).alias(settings.ID_COLUMN), *columns)


def predict_one(spark: SparkSession, model: AttritionModel, record: Mapping[str, Any], version: str, **options) -> Any:
    """One record through the same path; the result row comes back to the caller."""
    scored_at = options.pop("scored_at", F.current_timestamp())
    return predict(model, records_table(spark, [record]), version, scored_at, check=True, **options).first()


def score_versions(models: Mapping[str, AttritionModel], df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, model_version, churn_probability, predicted_class): a row per row and version, from one scan. The versions'
    scores are columns of one projection, which is turned into rows at the end."""
    keep = list(keep)
    wide, found = df, []
    for i, (version, model) in enumerate(models.items()):
        earlier = [c for names in found for c in names[1:]]
        names = (version, f"__probability_{i}", f"__class_{i}")
        features = [c for c in FEATURES if c in df.columns]
        scored = score(model, wide, [*dict.fromkeys([*keep, *features]), *earlier])
        wide = scored.withColumnsRenamed({"churn_probability": names[1], "predicted_class": names[2]}).drop("margin", "feature_values")
        found.append(names)
    rows = [
        F.struct(F.lit(v).alias("model_version"), F.col(p).alias("churn_probability"), F.col(c).alias("predicted_class")) for v, p, c in found
    ]
    return wide.select(*keep, F.inline(F.array(*rows)))


def compare_versions(models: Mapping[str, AttritionModel], df: DataFrame, label: str = settings.TARGET) -> DataFrame:
    """The evaluation row of every version on the same labelled table, which is read once."""
    return evaluate(score_versions(models, df, [label]), label, "churn_probability", "predicted_class")


def flat_results(results: DataFrame) -> DataFrame:
    """Results with ISO timestamps and features as JSON, for files that hold text."""
    return results.withColumns(
        {
            "prediction_timestamp": F.date_format("prediction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "top_features": F.to_json("top_features"),
        }
    )
