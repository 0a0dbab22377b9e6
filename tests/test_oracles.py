"""Every named query against its SQL counterpart on the smallest tables."""

import os

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES as NAMED

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, query in entry.queries().items() if name in NAMED}
MODELS = sorted(set(QUERIES) - set(ORACLE))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_only_model_queries_lack_sql():
    assert all(n.startswith("model_") for n in MODELS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


@pytest.mark.parametrize("name", MODELS)
def test_model_query_runs(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "contract_type" and df.count() > 0
