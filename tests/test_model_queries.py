import os

import pytest

from tidemark import settings
from tidemark.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_the_model_has_the_default_size(spark):
    """Fails for a model of 5 trees of depth 3."""
    model, _ = queries.model_of(spark, SF)
    trees = model.classifier.trees
    assert len(trees) == settings.DEFAULT_PARAMS["n_estimators"]
    assert model.classifier.getMaxDepth() == settings.DEFAULT_PARAMS["max_depth"]


def test_two_versions_are_compared(spark):
    rows = queries.model_evaluation(spark, SF).collect()
    assert {r["model_version"] for r in rows} == {"v_1", "v_2"}


def test_training_and_scoring_do_not_aggregate_the_orders_again(spark):
    """Fails where the split and every query work out the customers anew, up to five times each."""
    rows = queries._parts(spark, SF)
    plans = [df._jdf.queryExecution().toString() for df in rows]
    assert all("customers-" in p and "orders.parquet" not in p for p in plans)
    assert sum(r.count() for r in rows) == queries.testbed.customers(spark, SF).count()
