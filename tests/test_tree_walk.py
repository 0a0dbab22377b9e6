import pytest
from pyspark.sql import functions as F
from test_attribution import ROWS, TREE

from tidemark.operators import tree_walk

NODES = "tree int, node int, weight double, prediction double, cover double, gain double, left int, right int, feature int, threshold double, swapped boolean"


def node_rows(tree, weight, nodes):
    out = []
    for node, (prediction, cover, left, right, feature, threshold, swapped) in nodes.items():
        inner = left >= 0
        out.append((tree, node, weight, prediction, cover, 0.5 if inner else 0.0, left, right, feature if inner else None, threshold if inner else None, swapped))
    return out


def margin(row, trees):
    total = 0.0
    for weight, nodes in trees:
        node = 0
        while nodes[node][2] >= 0:
            _, _, left, right, feature, threshold, swapped = nodes[node]
            node = left if (row[feature] <= threshold) != swapped else right
        total += 2.0 * weight * nodes[node][0]
    return total


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_walk_against_a_loop_over_rows_and_trees(spark, monkeypatch, sent):
    monkeypatch.setattr(tree_walk, "SENT_NODES", sent)
    trees = [(1.0, TREE), (0.25, {0: (0.75, 9.0, -1, -1, -1, 0.0, False)}), (0.5, {k: v for k, v in TREE.items()})]
    nodes = spark.createDataFrame([r for i, (w, t) in enumerate(trees) for r in node_rows(i, w, t)], NODES)
    data = [(i % 3, [float(x) for x in r], float(i)) for i, r in enumerate([*ROWS.tolist(), *ROWS.tolist()])]
    rows = spark.createDataFrame(data, "node int, feature_values array<double>, weight double")  # names that clash, repeated keys
    got = tree_walk.walk(rows, nodes, 3).collect()
    assert sorted((r["weight"], r["node"]) for r in got) == sorted((w, n) for n, _, w in data)
    for r in got:
        expected = margin(r["feature_values"], trees)
        assert r["walked_margin"] == pytest.approx(expected) and r["walked_probability"] == pytest.approx(1 / (1 + 2.718281828459045**-expected))
    assert tree_walk.walk(rows.limit(0), nodes, 3).count() == 0


def test_walk_shuffles_only_the_sums(spark):
    nodes = spark.createDataFrame(node_rows(0, 1.0, TREE), NODES)
    rows = spark.createDataFrame([([0.0, 1.0, 0.0, 9.0],)], "feature_values array<double>")
    plan = tree_walk.walk(rows, nodes, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_gains_are_shares_of_all_splits(spark):
    nodes = spark.createDataFrame(node_rows(0, 1.0, TREE), NODES)
    got = {r.feature: r.importance for r in tree_walk.gains(nodes, ["a", "b", "c", "d"]).collect()}
    covers = {"a": 100.0 + 40.0, "b": 60.0, "c": 40.0, "d": 0.0}
    assert got == pytest.approx({k: v / 240.0 for k, v in covers.items()})
    leaf = nodes.where(F.col("node") == 3).withColumn("node", F.lit(0))
    assert {r.importance for r in tree_walk.gains(leaf, ["a"]).collect()} == {0.0}


def test_sums_are_added_up_without_a_sort(spark):
    """Fails where the row is a value of the aggregation, which sorts all steps of all trees."""
    nodes = spark.createDataFrame(node_rows(0, 1.0, TREE), NODES)
    schema = "id string, feature_values array<double>, small float, inner struct<x: double, y: array<float>>"
    odd = [float("nan"), float("inf"), -0.0, 0.1 + 0.2]
    data = [("a", odd, 0.1, (5e-324, [0.1, None])), ("a", [1.0, None, 0.0, 9.0], None, None), (None, [0.0, 1.0, 0.0, 9.0], 1.5, (None, None))]
    rows = spark.createDataFrame(data, schema)
    walked = tree_walk.walk(rows, nodes, 3)
    plan = walked._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "HashAggregate" in plan
    assert sorted(map(repr, walked.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
    assert tree_walk.walk(rows, nodes, 3, keep=["id"]).columns == ["id", "walked_margin", "walked_probability"]
