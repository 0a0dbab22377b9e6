"""Exact additive attributions for boosted trees (path-dependent tree SHAP).

The model explains twice its margin, which is the log-odds of the positive class. Summed over the subsets of the other
features, the value of a feature at a leaf is an integral over t from 0 to 1 of a polynomial: the product of the factors
``t x met + (1 - t) x share`` of the other features on the path, where ``met`` says whether a row meets all conditions on a feature
and ``share`` is the part of the training weight that does. A quadrature with half as many points as a path has features
is exact for it. (Lundberg et al., "From local explanations to global understanding with explainable AI for trees", 2020, for
the definition; Yu et al., "Linear TreeShap", 2022, for the polynomials.)

A tree is cut into small subtrees. What a subtree's leaves give a row depends only on which conditions of the path to it and
which splits in it the row meets, so that the polynomials are worked out for patterns, not for rows. Every distinct condition
of the model is compared with a batch of rows once; explaining the rows is then looking patterns up.

The leaf table is as large as the model, not the data, and is broadcast, once for each table. Rows pass through Arrow
batches; only the feature array crosses into Python.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import new_folder
from tidemark.sources.storage import remove

# executors get this module's functions with the task, also where the package is not installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_SHARE = 1e-30  # stands for a share of 0, which would divide; far below what a double's digits can show
HEIGHT = 2  # splits below each other in a subtree
TABLE_BYTES = 96 << 20  # of patterns' values that a worker keeps; what is beyond is worked out for every batch
CONDITION_BYTES = 32 << 20  # of conditions of a batch that are held at once


@dataclass
class Subtree:
    """The leaves below a node and how they depend on a row.

    ``conditions`` are the numbers of the model's conditions that make the bits of a pattern. A leaf meets all that its path asks
    of a feature if the bits in ``mask`` equal ``want``; ``share`` of the training weight does (1 for features off its path)."""

    conditions: list[int]
    features: np.ndarray
    mask: np.ndarray  # (leaves, features), as are the next two
    want: np.ndarray
    share: np.ndarray
    value: np.ndarray  # of the leaves


@dataclass
class LeafTable:
    """Conditions (feature, low excluded, high included) and the subtrees that ask for them, the expected value over the training
    weight, and the number of features."""

    conditions: list[tuple[int, float, float]]
    subtrees: list[Subtree]
    base: float
    n_features: int
    shared: dict[str, Broadcast] = field(default_factory=dict, repr=False, compare=False)

    def broadcast(self, spark: SparkSession) -> Broadcast:
        """The table sent to the executors, once in a session."""
        key = spark.sparkContext.applicationId
        if key not in self.shared:
            # the empty dict is for what a Python worker keeps from task to task
            self.shared[key] = spark.sparkContext.broadcast(((self.conditions, self.subtrees, self.base, self.n_features), {}))
        return self.shared[key]

    def release(self) -> None:
        """Take the table back from the executors, once all that it explains has been written."""
        while self.shared:
            self.shared.popitem()[1].destroy()


def _heights(nodes: dict[int, tuple]) -> dict[int, int]:
    heights, order, stack = {}, [], [0]
    while stack:
        order.append(node := stack.pop())
        if nodes[node][2] >= 0:
            stack += nodes[node][2:4]
    for node in reversed(order):
        left, right = nodes[node][2:4]
        heights[node] = 0 if left < 0 else 1 + max(heights[left], heights[right])
    return heights


def _children(nodes: dict[int, tuple], node: int) -> Iterator[tuple[int, bool, float]]:
    """(child, whether it takes values up to the threshold, share of the weight) of a split."""
    _, cover, left, right, _, _, swapped = nodes[node]
    for child, below in ((left, not swapped), (right, swapped)):
        yield child, below, nodes[child][1] / cover if cover else 0.0


def _subtree(nodes: dict[int, tuple], root: int, path: dict[int, tuple], weight: float, number: Callable[[tuple], int]) -> Subtree:
    """The subtree of a node behind the conditions {feature: (low, high, share)} of its path."""
    bits = {("path", f): number((f, low, high)) for f, (low, high, _) in path.items()}
    leaves, stack = [], [(root, {f: (1 << i, 1 << i, p[2]) for i, (f, p) in enumerate(path.items())})]
    while stack:
        node, asked = stack.pop()
        prediction, _, left, _, feature, threshold, _ = nodes[node]
        if left < 0:
            leaves.append((2.0 * weight * prediction, asked))
            continue
        bit = 1 << len(bits)
        bits[node] = number((feature, -math.inf, threshold))
        for child, below, part in _children(nodes, node):
            mask, want, share = asked.get(feature, (0, 0, 1.0))
            stack.append((child, {**asked, feature: (mask | bit, want | bit * below, share * part)}))
    features = sorted({f for _, asked in leaves for f in asked})
    of = lambda i, off: np.array([[asked[f][i] if f in asked else off for f in features] for _, asked in leaves])
    return Subtree(list(bits.values()), np.array(features), of(0, 0), of(1, 0), of(2, 1.0), np.array([v for v, _ in leaves]))


def build_leaf_table(trees: dict[int, dict[int, tuple]], weights: dict[int, float], n_features: int) -> LeafTable:
    """Cut up trees given as {node id: (prediction, cover, left, right, feature, threshold, swapped)}."""
    base, subtrees, conditions = 0.0, [], {}
    for tree_id, nodes in trees.items():
        heights, stack = _heights(nodes), [(0, {})]
        while stack:
            node, path = stack.pop()
            if heights[node] <= HEIGHT:
                found = _subtree(nodes, node, path, weights[tree_id], lambda c: conditions.setdefault(c, len(conditions)))
                base += float(found.value @ found.share.prod(axis=1))
                if len(found.features):
                    subtrees.append(found)
                continue
            feature, threshold = nodes[node][4:6]
            for child, below, part in _children(nodes, node):
                low, high, share = path.get(feature, (-math.inf, math.inf, 1.0))
                low, high = (low, min(high, threshold)) if below else (max(low, threshold), high)
                stack.append((child, {**path, feature: (low, high, share * part)}))
    return LeafTable(list(conditions), subtrees, base, n_features)


def read_leaf_table(spark: SparkSession, classifier_path: str, n_features: int) -> LeafTable:
    """The leaf table of a saved classifier. Its node table is as large as the model."""
    weights = {int(r[0]): float(r[2]) for r in spark.read.parquet(f"{classifier_path}/treesMetadata").collect()}
    trees: dict[int, dict[int, tuple]] = defaultdict(dict)
    for r in spark.read.parquet(f"{classifier_path}/data").select("treeID", "nodeData.*").collect():
        feature, threshold, swapped = -1, 0.0, False
        if r.leftChild >= 0:
            feature, values, arity = r.split.featureIndex, list(r.split.leftCategoriesOrThreshold), r.split.numCategories
            if arity == -1:
                threshold = values[0]
            elif arity == 2:  # an indicator: the categories that go left are {0} or {1}
                threshold, swapped = 0.5, values == [1.0]
            else:
                raise ValueError(f"feature {feature} has {arity} categories; only indicators are expected")
        # the weighted count, not the raw one, says which share of the training rows went where
        trees[r.treeID][r.id] = (r.prediction, r.impurityStats[0], r.leftChild, r.rightChild, feature, threshold, swapped)
    return build_leaf_table(trees, weights, n_features)


def save_classifier(classifier: GBTClassificationModel, spark: SparkSession) -> str:
    """The folder of shared scratch space that a classifier in memory is saved in."""
    path = new_folder(spark, "classifier")
    classifier.write().overwrite().save(path)
    return path


def leaf_table(spark: SparkSession, classifier: GBTClassificationModel) -> LeafTable:
    """The leaf table of a classifier in memory, through the shared scratch folder, which is left as it was."""
    path = save_classifier(classifier, spark)
    try:
        return read_leaf_table(spark, path, classifier.numFeatures)
    finally:
        remove(spark, path)


def pattern_values(subtree: Subtree, patterns: np.ndarray) -> np.ndarray:
    """Shapley values (features, patterns) that the leaves of a subtree give for patterns of met conditions."""
    met = ((patterns & subtree.mask[:, :, None]) == subtree.want[:, :, None]).astype(float)
    share, out = np.maximum(subtree.share, NO_SHARE)[:, :, None], np.zeros((len(subtree.features), len(patterns)))
    lead = subtree.value[:, None, None] * (met - share)
    most = int((subtree.mask != 0).sum(axis=1).max())
    for point, weight in zip(*np.polynomial.legendre.leggauss((most + 1) // 2), strict=True):
        t = (point + 1) / 2
        factor = t * met
        factor += (1 - t) * share
        others = weight / 2 * factor.prod(axis=1, keepdims=True) / factor
        others *= lead
        out += others.sum(axis=0)
    return out


class BatchExplainer:
    """Explains batches of rows; its tables are built once per Python worker, as far as they fit."""

    def __init__(self, table: LeafTable):
        self.table = table
        self.tables: dict[int, np.ndarray] = {}
        self.room = TABLE_BYTES
        self.piece = max(256, CONDITION_BYTES // max(1, len(table.conditions)))

    def _values(self, number: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (features, patterns) of a subtree, and which pattern each row has."""
        if (ready := self.tables.get(number)) is not None:
            return ready, code
        subtree = self.table.subtrees[number]
        n = 1 << len(subtree.conditions)
        size = 8 * n * len(subtree.features)
        if size <= self.room:
            self.tables[number] = pattern_values(subtree, np.arange(n))
            self.room -= size
            return self.tables[number], code
        if n <= len(code):
            seen = np.zeros(n, bool)
            seen[code] = True
            place = np.cumsum(seen) - 1
            return pattern_values(subtree, np.flatnonzero(seen)), place[code]
        patterns, place = np.unique(code, return_inverse=True)
        return pattern_values(subtree, patterns), place

    def explain(self, rows: np.ndarray) -> np.ndarray:
        """(n, features) attributions of an (n, features) array."""
        out = np.zeros((rows.shape[1], rows.shape[0]))
        for start in range(0, len(rows), self.piece):
            self._explain(np.ascontiguousarray(rows[start : start + self.piece].T), out[:, start : start + self.piece])
        return out.T

    def _explain(self, columns: np.ndarray, out: np.ndarray) -> None:
        met = np.empty((len(self.table.conditions), columns.shape[1]), np.uint8)
        for i, (feature, low, high) in enumerate(self.table.conditions):
            column = columns[feature]
            met[i] = (column <= high) if low == -math.inf else (column > low) & (column <= high)
        for number, subtree in enumerate(self.table.subtrees):
            code = np.zeros(columns.shape[1], np.uint8 if len(subtree.conditions) <= 8 else np.int64)
            for c in reversed(subtree.conditions):
                code <<= 1
                code |= met[c]
            values, place = self._values(number, code.astype(np.intp))
            for feature, own in zip(subtree.features.tolist(), values, strict=True):
                out[feature] += own[place]


def attribution_udf(spark: SparkSession, table: LeafTable):
    """A function of an ``array<double>`` column of features that gives their attributions. The table stays with the
    executors until its ``release``."""
    shared = table.broadcast(spark)

    @F.pandas_udf("array<double>")
    def attributions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        given, kept = shared.value
        explainer = kept.setdefault("explainer", BatchExplainer(LeafTable(*given)))
        width = explainer.table.n_features
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            rows = np.vstack(batch.to_numpy())
            if rows.shape[1] != width:
                raise ValueError(f"rows have {rows.shape[1]} features, but the model expects {width}")
            yield pd.Series(list(explainer.explain(rows)))

    return attributions


def margin(raw_prediction: Column) -> Column:
    """Log-odds of the positive class from the classifier's raw prediction array."""
    return 2.0 * raw_prediction[1]
