import re

import numpy as np
from test_decontamination import brute_force as hits
from test_jaccard import classes
from test_substring_dedup import brute_force as repeats

import corpus_pipeline
from tidemark.llm import decontamination


def run(spark, docs, sf):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(spark.createDataFrame(stage(spark, out[-1], sf).toArrow()))
    return out


def test_every_stage_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = run(spark, docs, sf)
    assert [s.columns for s in steps[:-1]] == [docs.columns] * 5
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps]
    # languages: clean documents stay
    assert set(texts[1]) <= set(texts[0]) and len(texts[1]) >= 0.99 * len(texts[0])
    # near-duplicates: one of each group
    ids = sorted(texts[1])
    roots = classes([texts[1][i] for i in ids])
    assert sorted(texts[2]) == sorted({ids[r] for r in roots})
    # repeated passages
    ids = sorted(texts[2])
    for i, (_, gone, kept) in zip(ids, repeats([texts[2][i] for i in ids], 35), strict=True):
        assert texts[3][i] == (kept if gone else texts[2][i])
    # benchmark passages
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    for i, (n, hit, _) in zip(ids, hits([texts[3][i] for i in ids], items), strict=True):
        left = decontamination.words_of(texts[4][i].encode())
        every = decontamination.words_of(texts[3][i].encode())
        assert left == [w for k, w in enumerate(every) if k not in set(hit)]
        assert hit or texts[4][i] == texts[3][i]
    # tokens
    assert texts[5] == texts[4]
    assert all(r["n_chars"] == len(r["text"]) for r in steps[4].collect())
    assert all(r["n_tokens"] == len(np.frombuffer(r["packed"], "<u4")) for r in steps[5].collect())


def test_odd_rows(spark, sf):
    words = " ".join(f"Wort{i} und der die das mit von" for i in range(20))
    rows = [
        (1, words, "de", "s", 1, "x"),
        (1, words, "de", "s", 1, "x"),
        (2, words, None, None, None, "x"),
        (None, "ein anderer Text mit der und die", "de", "s", 1, "x"),
        (3, None, "de", "s", 1, "x"),
        (4, "", "de", "s", 1, "x"),
        (5, "%% 12", "de", "s", 1, "x"),
        (6, words + " Ende, aber anders und mit mehr Worten als vorher", "de", "s", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string")
    steps = run(spark, docs, sf)
    assert sorted(str(r["doc_id"]) for r in steps[1].collect()) == ["1", "1", "2", "6", "None"]
    kept = sorted(str(r["doc_id"]) for r in steps[2].collect())
    assert kept[0] == "1" and kept[-1] == "None" and "2" not in kept
    assert all(s.columns == docs.columns for s in steps[:5])
    empty = run(spark, docs.limit(0), sf)
    assert [s.count() for s in empty] == [0] * 6


def test_stages_are_named():
    assert len(corpus_pipeline.STAGES) == 5 and all(re.fullmatch(r"[\w -]+", n) for n, _ in corpus_pipeline.STAGES)
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_is_the_stages(spark, sf):
    last = corpus_pipeline.run(spark, sf)
    assert last.count() > 0 and {"doc_id", "n_tokens", "packed", "text"} <= set(last.columns)
