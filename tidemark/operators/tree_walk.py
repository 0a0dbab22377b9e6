"""Boosted trees as a table of nodes, scored and summed up by joins.

A second way to a model's scores and gains, independent of the library's prediction code: every row starts at the root of
every tree and goes down one level per join with the node table. The walk shuffles nothing but the sums per row. The
node table is as large as the model; it is sent to the tasks only while it has at most ``SENT_NODES`` nodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENT_NODES = 1_000_000  # about 60 MB


def node_table(spark: SparkSession, classifier_path: str) -> DataFrame:
    """(tree, node, weight, prediction, cover, gain, left, right, feature, threshold, swapped) of a saved classifier; a leaf has
    the children -1. An indicator split sends its category left: {0} like a threshold of 0.5, {1} swapped."""
    weights = spark.read.parquet(f"{classifier_path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    data = spark.read.parquet(f"{classifier_path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    values, continuous = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories") == -1
    inner = F.col("leftChild") >= 0
    return data.join(weights, "tree").select(
        "tree",
        F.col("id").alias("node"),
        "weight",
        "prediction",
        F.col("impurityStats")[0].alias("cover"),
        F.when(inner, F.col("gain")).otherwise(0.0).alias("gain"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get(values, F.lit(0))).when(inner, 0.5).alias("threshold"),
        (inner & ~continuous & (F.get(values, F.lit(0)) == 1.0)).alias("swapped"),
    )


def _sent(nodes: DataFrame) -> DataFrame:
    return F.broadcast(nodes) if nodes.count() <= SENT_NODES else nodes


def _retyped(kind: T.DataType, text: bool) -> T.DataType:
    """The type with nulls allowed everywhere and, with ``text``, strings for floating-point numbers."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _retyped(f.dataType, text)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_retyped(kind.elementType, text))
    if isinstance(kind, T.MapType):
        return T.MapType(_retyped(kind.keyType, text), _retyped(kind.valueType, text))
    return T.StringType() if text and isinstance(kind, (T.DoubleType, T.FloatType)) else kind


def walk(rows: DataFrame, nodes: DataFrame, depth: int, values: str = "feature_values", keep: Sequence[str] | None = None) -> DataFrame:
    """The rows, or their columns in ``keep``, with ``walked_margin`` and ``walked_probability``, by at most ``depth`` steps from every root.

    Rows need no key: each carries its columns down all trees as one struct with a number of its own. The struct is part of the
    key that the sums are grouped by, so that they are added up in a hash table; as a value it would have all steps sorted
    first. Floating-point numbers are text meanwhile, which gives them back exactly, and which a key need not normalise.
    """
    nodes = _sent(nodes.select(F.col("tree").alias("__tree"), F.col("node").alias("__node"), "weight", "prediction", "left", "right", "feature", "threshold", "swapped"))
    trees = nodes.where(F.col("__node") == 0).agg(F.sort_array(F.collect_list("__tree")).alias("trees")).scalar()
    kept = rows if keep is None else rows.select(*(f"`{c}`" for c in keep))
    row = F.struct(*(F.col(f"`{c}`") for c in kept.columns)).cast(_retyped(kept.schema, True)).alias("__row")
    at = rows.select(row, F.col(f"`{values}`").alias("__values"), F.monotonically_increasing_id().alias("__number"))
    at = at.select("*", F.explode(trees).alias("tree")).withColumn("node", F.lit(0))
    for step in range(depth + 1):
        met = at.join(nodes, (F.col("tree") == F.col("__tree")) & (F.col("node") == F.col("__node")), "inner")
        below = (F.get("__values", F.col("feature")) <= F.col("threshold")) != F.col("swapped")
        following = F.when(F.col("left") < 0, F.col("node")).when(below, F.col("left")).otherwise(F.col("right"))
        if step == depth:
            at = met
        else:
            at = met.select("__row", "__values", "__number", "tree", following.alias("node"))
    value = F.sum(2.0 * F.col("weight") * F.col("prediction")).alias("walked_margin")
    sums = at.groupBy("__number", "__row").agg(value).withColumn("__row", F.col("__row").cast(_retyped(kept.schema, False)))
    return sums.select("__row.*", "walked_margin", (1.0 / (1.0 + F.exp(-F.col("walked_margin")))).alias("walked_probability"))


def gains(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, importance): the gain of every split times its training weight, as a share of all; each feature has a row."""
    listed = F.posexplode(F.array(*map(F.lit, names))).alias("feature", "name")
    every = nodes.sparkSession.range(1).select(listed)
    split = nodes.where("left >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("cover")).alias("gain"))
    total = split.agg(F.sum("gain")).scalar()
    share: Column = F.coalesce(F.try_divide("gain", total), F.lit(0.0))
    return every.join(split, "feature", "left").select(F.col("name").alias("feature"), share.alias("importance"))
