"""The entry point without its optional parts."""

import sys

import pytest

import __spark_entry__ as entry
from tidemark.plans.queries import QUERIES


@pytest.mark.parametrize("missing", ["xxhash", "public_tokenizers", "tidemark.llm"])
def test_a_missing_package_costs_only_the_queries_that_need_it(monkeypatch, missing):
    for name in [m for m in sys.modules if m.startswith(("tidemark.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # importing it raises ImportError
    with pytest.warns(UserWarning, match="left out") if not missing.startswith("tidemark") else _nothing():
        found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" not in found
    assert set(entry.oracle_sql()) <= set(found)


class _nothing:
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False
