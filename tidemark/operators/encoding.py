"""Imputation, scaling and one-hot encoding.

Fitting is one scan and one aggregation over the moments of the numeric columns and the counts of the categories.
The fitted numbers become literals of native ML stages, so applying them is a projection and
saving them needs no Python class on the other side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.functions.columns import nan_to_null, sql_double, sql_name, sql_string

MOST_CATEGORIES = 10_000  # of a column

STATE_SCHEMA = (
    "position int, feature string, kind string, mean double, scale double, mode string, categories array<string>"
)


def route_columns(
    df: DataFrame, exclude: Sequence[str] = (settings.ID_COLUMN, settings.TARGET)
) -> tuple[list[str], list[str]]:
    """(numeric, categorical): numeric columns by type, categorical columns by configuration."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    categorical = [c for c in df.columns if c in settings.CATEGORICAL_FEATURES]
    return numeric, categorical


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, scale): the mean of the known values, and the population standard
    deviation of the column after its gaps are filled with that mean (1 if it is zero).

    Filling k of n values leaves the sum of squares unchanged, so the deviation of the filled
    column follows from the variance of the known values and no second pass is needed.
    """
    df = nan_to_null(df.select(*columns))
    n = F.count(F.lit(1))
    stats = []
    for i, c in enumerate(columns):
        spread = F.sqrt(F.var_pop(c) * F.count(c) / n)
        stats.append(F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean{i}"))
        stats.append(F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias(f"scale{i}"))
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"mean{i}").alias("mean"), F.col(f"scale{i}").alias("scale"))
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*stats).select(F.inline(rows))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n) for the known categories of all columns, in one pass."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    return (
        df.select(F.inline(entries))
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_modes(counts: DataFrame) -> DataFrame:
    """(feature, mode): the most frequent category, the smallest one on ties."""
    return counts.groupBy("feature").agg(
        F.min_by("category", F.struct((-F.col("n")).alias("n"), "category")).alias("mode")
    )


@dataclass(frozen=True)
class FittedEncoder:
    means: dict[str, float]
    scales: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]

    @property
    def feature_names(self) -> list[str]:
        """Numeric columns first, then ``<column>_<category>`` in sorted order."""
        return list(self.means) + [f"{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def stages(self, spark: SparkSession, output: str = "features") -> list[Transformer]:
        """Native stages that append the feature vector. An unseen category encodes to zeros."""
        numeric = {
            c: f"(coalesce(nanvl(double({sql_name(c)}), null), {sql_double(m)}) - {sql_double(m)})"
            f" / {sql_double(self.scales[c])}"
            for c, m in self.means.items()
        }
        filled = {c: f"coalesce({sql_name(c)}, {sql_string(m)})" for c, m in self.modes.items()}
        num_out = {c: f"__num_{i}" for i, c in enumerate(numeric)}
        cat_out = {c: f"__cat_{i}" for i, c in enumerate(filled)}
        parts = [f"{e} AS {num_out[c]}" for c, e in numeric.items()] + [f"{e} AS {cat_out[c]}" for c, e in filled.items()]
        stages: list[Transformer] = [SQLTransformer(statement=f"SELECT {', '.join(['*', *parts])} FROM __THIS__")]
        inputs = list(num_out.values())
        if filled:
            indexed = {c: f"__idx_{i}" for i, c in enumerate(filled)}
            hot = {c: f"__hot_{i}" for i, c in enumerate(filled)}
            indexers = [
                StringIndexerModel.from_labels(
                    self.categories[c], inputCol=cat_out[c], outputCol=indexed[c], handleInvalid="keep"
                )
                for c in filled
            ]
            # the indexers' column metadata fixes the sizes, so fitting reads no rows; the
            # bucket for unknown categories is the last one and is the one dropped
            empty = spark.createDataFrame([], ", ".join(f"{n} string" for n in cat_out.values()))
            one_hot = OneHotEncoder(inputCols=list(indexed.values()), outputCols=list(hot.values())).fit(
                PipelineModel(indexers).transform(empty)
            )
            stages += [*indexers, one_hot]
            inputs += list(hot.values())
        stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
        return stages

    def pipeline(self, spark: SparkSession, output: str = "features") -> PipelineModel:
        return PipelineModel(self.stages(spark, output))

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Append the feature vector; the helper columns are dropped."""
        if not self.means and not self.categories:
            return df.withColumn(output, F.array().cast("array<double>"))
        return self.pipeline(df.sparkSession, output).transform(df).select(*df.columns, output)

    def transform_wide(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns and one double column per encoded feature."""
        values = vector_to_array("features")
        return self.transform(df).select(*keep, values.alias("__v")).select(
            *keep, *[F.col("__v")[i].alias(n) for i, n in enumerate(self.feature_names)]
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per input column."""
        rows = [(i, c, "numeric", m, self.scales[c], None, None) for i, (c, m) in enumerate(self.means.items())]
        rows += [
            (len(rows) + i, c, "categorical", None, None, m, self.categories[c])
            for i, (c, m) in enumerate(self.modes.items())
        ]
        spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedEncoder:
        rows = spark.read.schema(STATE_SCHEMA).parquet(path).orderBy("position").collect()
        numeric = [r for r in rows if r.kind == "numeric"]
        categorical = [r for r in rows if r.kind == "categorical"]
        return FittedEncoder(
            {r.feature: r["mean"] for r in numeric},
            {r.feature: r["scale"] for r in numeric},
            {r.feature: r["mode"] for r in categorical},
            {r.feature: list(r.categories) for r in categorical},
        )


def fitted_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row (feature, category, n) per known category, and one without a feature that has the numeric statistics as ``mean<i>``
    and ``scale<i>``: all that an encoder is fitted from, in one scan and one aggregation.

    Every row is counted once for each categorical column and once for the numeric ones, whose values only count there.
    """

    def entry(feature: Column, category: Column) -> Column:
        return F.struct(feature.cast("string").alias("feature"), category.cast("string").alias("category"))

    entries = [entry(F.lit(None), F.lit(None))] + [entry(F.lit(c), F.col(c)) for c in categorical]
    values = [F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(numeric)]
    spread = nan_to_null(df.select(*numeric, *categorical)).select(*values, F.inline(F.array(*entries)))
    whole = F.col("feature").isNull()
    stats, n = [], F.count_if(whole)
    for i in range(len(numeric)):
        own = F.when(whole, F.col(f"__v{i}"))
        deviation = F.sqrt(F.var_pop(own) * F.count(own) / n)
        stats.append(F.coalesce(F.avg(own), F.lit(0.0)).alias(f"mean{i}"))
        stats.append(F.when(deviation > 0, deviation).otherwise(F.lit(1.0)).alias(f"scale{i}"))
    known = whole | F.col("category").isNotNull()
    return spread.where(known).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"), *stats)


def fit_encoder(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], most_categories: int = MOST_CATEGORIES
) -> FittedEncoder:
    """Fit on a table, which is read once. The driver receives one row for the numeric columns and one per category, which
    one-hot encoding needs to lay out its columns. A column of more than ``most_categories`` is refused: it would make as many
    features; no more rows than that are fetched.
    """
    most = 1 + len(categorical) * most_categories
    rows = fitted_counts(df, numeric, categorical).limit(most + 1).collect()
    found: dict[str, list] = {c: [] for c in categorical}
    means: dict[str, float] = {c: 0.0 for c in numeric}
    scales: dict[str, float] = {c: 1.0 for c in numeric}
    for r in rows:
        if r.feature is not None:
            found[r.feature].append((-r.n, r.category))
            continue
        for i, c in enumerate(numeric):
            means[c], scales[c] = r[f"mean{i}"], r[f"scale{i}"]
    large = [c for c in categorical if len(found[c]) > most_categories]
    if large or len(rows) > most:
        raise ValueError(f"More than {most_categories} categories: {', '.join(large) or 'in all'}; not for one-hot encoding")
    known = [c for c in categorical if found[c]]  # a column without a known value carries nothing to encode
    modes = {c: min(found[c])[1] for c in known}
    return FittedEncoder(means, scales, modes, {c: sorted(v for _, v in found[c]) for c in known})
