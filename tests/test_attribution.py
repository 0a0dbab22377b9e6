import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import attribution as a
from tidemark.operators import explanations as ex

# one tree: (prediction, cover, left, right, feature, threshold, swapped)
TREE = {
    0: (0.0, 100.0, 1, 2, 0, 0.5, False),
    1: (0.0, 60.0, 3, 4, 1, 2.0, False),
    2: (0.0, 40.0, 5, 6, 2, 0.5, True),  # an indicator whose category 1 goes left
    3: (1.0, 20.0, -1, -1, -1, 0.0, False),
    4: (-2.0, 40.0, 7, 8, 0, -1.0, False),  # feature 0 again on this path
    5: (3.0, 10.0, -1, -1, -1, 0.0, False),
    6: (0.5, 30.0, -1, -1, -1, 0.0, False),
    7: (4.0, 15.0, -1, -1, -1, 0.0, False),
    8: (-1.0, 25.0, -1, -1, -1, 0.0, False),
}
ROWS = np.array([[0.0, 1.0, 0.0, 9.0], [0.0, 3.0, 1.0, 9.0], [-2.0, 3.0, 0.0, 9.0], [1.0, 0.0, 1.0, 9.0], [1.0, 5.0, 0.0, 9.0]])


def expected_value(row, known, node=0):
    """Value of the tree when only some features are known: the others follow the training shares."""
    prediction, cover, left, right, feature, threshold, swapped = TREE[node]
    if left < 0:
        return 2.0 * prediction
    if feature in known:
        goes_left = (row[feature] <= threshold) != swapped
        return expected_value(row, known, left if goes_left else right)
    return sum(TREE[c][1] / cover * expected_value(row, known, c) for c in (left, right)) if cover else 0.0


def shapley(row, n):
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        total = 0.0
        for size in range(n):
            for s in itertools.combinations(rest, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                total += w * (expected_value(row, {*s, i}) - expected_value(row, set(s)))
        out.append(total)
    return out


@pytest.mark.parametrize("kept,height", [(1 << 20, 2), (0, 2), (0, 0), (1 << 20, 9), (200, 1)])
def test_attributions_equal_brute_force_shapley_values(monkeypatch, kept, height):
    monkeypatch.setattr(a, "TABLE_BYTES", kept)  # 0: no table is kept
    monkeypatch.setattr(a, "HEIGHT", height)
    table = a.build_leaf_table({0: TREE}, {0: 1.0}, 4)
    got = a.BatchExplainer(table).explain(ROWS)
    assert table.base == pytest.approx(expected_value(ROWS[0], set()))
    for row, values in zip(ROWS, got):
        assert values == pytest.approx(shapley(row, 4), abs=1e-12)
        assert values.sum() == pytest.approx(expected_value(row, {0, 1, 2, 3}) - table.base)


def drawn_tree(draw, depth, n_features, node=0, cover=512.0):
    """A random tree in which features come again on a path and some children have no training weight."""
    if depth == 0 or draw.random() < 0.15:
        return {node: (float(draw.normal()), cover, -1, -1, -1, 0.0, False)}
    part = float(draw.choice([0.0, 0.25, 0.5, 0.9]))
    left, right = 2 * node + 1, 2 * node + 2
    split = (0.0, cover, left, right, int(draw.integers(n_features)), float(draw.integers(-3, 4)), bool(draw.random() < 0.3))
    below = drawn_tree(draw, depth - 1, n_features, left, cover * part) | drawn_tree(draw, depth - 1, n_features, right, cover * (1 - part))
    return {node: split, **below}


@pytest.mark.parametrize("depth,n_features,trees", [(2, 3, 40), (4, 5, 12), (7, 6, 4), (9, 2, 4)])
def test_random_trees_against_brute_force(monkeypatch, depth, n_features, trees):
    draw = np.random.default_rng(depth)
    rows = np.r_[draw.integers(-4, 5, (12, n_features)), draw.normal(size=(12, n_features))].astype(float)
    for k in range(trees):
        monkeypatch.setattr(a, "TABLE_BYTES", k % 2 * 4096)
        tree = drawn_tree(draw, depth, n_features)
        table = a.build_leaf_table({0: tree}, {0: 1.0}, n_features)
        got = a.BatchExplainer(table).explain(rows)
        monkeypatch.setitem(globals(), "TREE", tree)
        for row, values in zip(rows, got):
            assert values == pytest.approx(shapley(row, n_features), abs=1e-9)
            assert values.sum() + table.base == pytest.approx(expected_value(row, set(range(n_features))))


def test_shares_of_zero_are_a_limit():
    tree = {0: (0.0, 10.0, 1, 2, 0, 0.5, False), 1: (0.0, 10.0, 3, 4, 1, 0.5, False), 2: (5.0, 0.0, -1, -1, -1, 0.0, False)}
    tree |= {3: (1.0, 4.0, -1, -1, -1, 0.0, False), 4: (2.0, 6.0, -1, -1, -1, 0.0, False)}
    table = a.build_leaf_table({0: tree}, {0: 1.0}, 2)
    got = a.BatchExplainer(table).explain(np.array([[1.0, 0.0], [0.0, 1.0]]))
    assert got.sum(1) + table.base == pytest.approx([10.0, 4.0])
    assert got[0] == pytest.approx([(10 - 3.2 + 10 - 2) / 2, (2 - 3.2 + 0) / 2]) and got[1][0] == pytest.approx(0)


def test_a_batch_in_pieces(monkeypatch):
    table = a.build_leaf_table({0: TREE}, {0: 1.0}, 4)
    rows = np.tile(ROWS, (200, 1))
    whole = a.BatchExplainer(table).explain(rows)
    monkeypatch.setattr(a, "CONDITION_BYTES", 1)
    assert (a.BatchExplainer(table).explain(rows) == whole).all()


def test_the_table_is_sent_once_and_released(spark):
    table = a.build_leaf_table({0: TREE}, {0: 1.0}, 4)
    df = spark.createDataFrame([([0.0, 1.0, 0.0, 9.0],)], "v array<double>")
    for _ in range(2):
        assert df.select(a.attribution_udf(spark, table)("v").alias("s")).first().s == pytest.approx(shapley(ROWS[0], 4))
    assert len(table.shared) == 1
    table.release()
    assert not table.shared


def test_a_tree_without_splits_only_moves_the_base():
    table = a.build_leaf_table({0: {0: (0.25, 10.0, -1, -1, -1, 0.0, False)}}, {0: 2.0}, 3)
    assert table.base == 1.0 and (a.BatchExplainer(table).explain(np.zeros((2, 3))) == 0).all()


def test_udf_checks_the_width(spark):
    explain = a.attribution_udf(spark, a.build_leaf_table({0: TREE}, {0: 1.0}, 4))
    df = spark.createDataFrame([([0.0, 1.0, 0.0, 9.0],)], "v array<double>")
    assert df.select(explain("v").alias("s")).first().s == pytest.approx(shapley(ROWS[0], 4))
    with pytest.raises(Exception, match="3 features"):
        df.select(explain(F.slice("v", 1, 3))).collect()


NAMES = ["a", "b", "c"]


def shap_table(spark):
    rows = [(1, [0.1, -0.5, 0.5], True), (2, [-0.2, 0.0, 0.1], False), (3, [0.3, 0.3, -0.1], True)]
    return spark.createDataFrame(rows, "customer_id int, shap array<double>, risky boolean")


def test_top_features_keep_feature_order_on_ties(spark):
    df = shap_table(spark).select("customer_id", ex.top_features(F.col("shap"), NAMES, 2).alias("t"))
    got = {r.customer_id: [tuple(x) for x in r.t] for r in df.collect()}
    assert got == {1: [("b", -0.5), ("c", 0.5)], 2: [("a", -0.2), ("c", 0.1)], 3: [("a", 0.3), ("b", 0.3)]}
    more = shap_table(spark).select(ex.top_features(F.col("shap"), NAMES, 9).alias("t")).first().t
    assert len(more) == 3
    with pytest.raises(ValueError, match="positive"):
        ex.top_features(F.col("shap"), NAMES, 0)


def test_top_features_need_no_shuffle(spark):
    plan = shap_table(spark).select(ex.top_features(F.col("shap"), NAMES))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_importances(spark):
    overall = {r.feature: r.importance for r in ex.mean_magnitude(shap_table(spark), "shap", NAMES).collect()}
    assert overall == pytest.approx({"a": 0.2, "b": 0.8 / 3, "c": 0.7 / 3})
    tops = shap_table(spark).select(ex.top_features(F.col("shap"), NAMES, 1).alias("top_features"))
    listed = {r.feature: (r.importance, r.n_rows) for r in ex.top_feature_importance(tops).collect()}
    assert listed == {"b": (0.5, 1), "a": (0.25, 2)}


def test_group_difference_needs_both_groups(spark):
    rows = {r.feature: r.difference for r in ex.risk_group_difference(shap_table(spark), "shap", "risky", NAMES).collect()}
    assert rows == pytest.approx({"a": 0.4, "b": -0.1, "c": 0.1})
    assert ex.risk_group_difference(shap_table(spark).where("risky"), "shap", "risky", NAMES).isEmpty()


def test_additivity(spark):
    df = spark.createDataFrame([([0.1, 0.2], 1.0, 1.3), ([0.1, 0.2], 1.0, 1.4)], "v array<double>, b double, m double")
    row = ex.additivity_check(df, "v", "b", "m").first()
    assert (row.n_rows, row.n_violations) == (2, 1) and row.max_error == pytest.approx(0.1)


def test_raw_values_skip_names_that_are_not_columns(spark):
    tops = shap_table(spark).select("customer_id", ex.top_features(F.col("shap"), NAMES, 2).alias("top_features"))
    raw = spark.createDataFrame([(1, 7.0, "x"), (3, 8.0, None)], "customer_id int, b double, other string")
    rows = sorted(map(tuple, ex.with_raw_values(tops, raw).collect()))
    assert rows == [(1, "b", "7.0", -0.5, "Decreases"), (3, "b", "8.0", 0.3, "Increases")]
