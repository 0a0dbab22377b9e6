import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    """The documents as a list of (doc_id, text)."""
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def odd(spark):
    """A function that makes documents of texts, with null and repeated ids and columns of clashing names."""

    def make(texts, ids=None):
        ids = ids or [None if i == 3 else i % 50 for i in range(len(texts))]
        rows = [(i, t, 1, "x", "y", 2.0) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, n_words int, doc string, fingerprint string, score double"
        )

    return make
