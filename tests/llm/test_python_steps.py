"""A task that runs two steps of Python at once takes two workers, which an executor then keeps with all they hold."""

import pytest

from tidemark.llm import decontamination, substring_dedup

PYTHON = {"MapInArrow", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"}


def most_at_once(plan):
    """The most steps of Python that a task of any stage below runs in a row."""
    found = []

    def walk(node):
        below = max((walk(node.children().apply(i)) for i in range(node.children().size())), default=0)
        if "Exchange" in node.nodeName():
            found.append(below)
            return 0
        return below + (node.nodeName() in PYTHON)

    return max(walk(plan), *found) if found else walk(plan)


@pytest.fixture
def whole_plans(spark):
    """Plans as they are before they run, with joins as of large tables."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(table):
    return table._jdf.queryExecution().executedPlan()


def test_a_task_of_repeated_passages_runs_one_step_of_python(odd, whole_plans):
    passage = " ".join(map(str, range(40)))
    assert most_at_once(plan(substring_dedup.without_repeats(odd([passage, passage, None, "short"])))) == 1


def test_a_task_of_benchmark_passages_runs_one_step_of_python(spark, odd, whole_plans, monkeypatch):
    benchmark = spark.createDataFrame([(i, f"one two three four {i}") for i in range(30)], "item_id bigint, text string")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)  # more than one block of items
    texts = ["a, ONE two-three four 7. b one two three four 21 c", "four five", None]
    assert most_at_once(plan(decontamination.find(odd(texts), benchmark))) == 1
    cleaned = decontamination.clean(odd(texts), benchmark)
    assert most_at_once(plan(cleaned)) == 1
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {0: "a, . b  c", 1: "four five", 2: None}
