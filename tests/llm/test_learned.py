"""Language ID and the quality classifier: held-out accuracy and odd cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import languages, quality, queries

LARGE = "/root/testdata/sf0.01"


def crc(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_languages_of_held_out_documents(spark, sf):
    rows = queries.op4_language(spark, LARGE).collect()
    truth = dict(map(tuple, spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "lang").collect()))
    assert len(rows) == len(truth) and all(r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    apart = [truth[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert np.mean(apart) > 0.98


def test_mixtures_and_texts_without_letters(spark, odd):
    base = [("en", "the and of with that this from which have there "), ("es", "el los que para con una del por ñu más ")]
    train = spark.createDataFrame([(i, lang, text * 20) for i, (lang, text) in enumerate(base)] + [(9, None, "zz"), (10, "en", None)], "doc_id bigint, lang string, text string")
    model = languages.fit(train)
    assert model.names == ["en", "es"]
    mixed = base[0][1] * 3 + base[1][1]
    rows = languages.predict(odd([None, "", "12 %%", base[1][1].upper(), mixed, "→ 😀", "x " * 20_000]), model).collect()
    assert [r["lang_pred"] for r in rows][:4] == ["und", "und", "und", "es"] and rows[5]["lang_pred"] == "und"
    assert rows[0]["score"] == 0 and rows[3]["languages"] == {"es": 1.0}
    assert rows[4]["lang_pred"] == "en" and 0.6 < rows[4]["score"] < 0.85 and set(rows[4]["languages"]) == {"en", "es"}
    assert languages.predict(odd([]), model).count() == 0
    nothing = languages.fit(train.limit(0))
    assert [r["lang_pred"] for r in languages.predict(odd(["some text"]), nothing).collect()] == ["und"]


def test_a_text_is_judged_by_itself(spark):
    """Proportions do not depend on the texts in the same batch."""
    draw = np.random.default_rng(4)
    sets = [("en", "the and of with that this from"), ("es", "el los que para con una del"), ("de", "der die und nicht mit von ein")]
    train = spark.createDataFrame([(i, lang, words * 20) for i, (lang, words) in enumerate(sets)], "doc_id bigint, lang string, text string")
    model = languages.fit(train)
    words = [w for _, some in sets for w in some.split()]
    texts = [" ".join(draw.choice(words, size=draw.integers(1, 60))).encode() for _ in range(40)]
    together = languages.infer(texts, model)
    assert [languages.infer([t], model)[0] for t in texts] == together
    assert any(len(x) > 1 for x in together)


def test_proportions_maximise_the_likelihood():
    draw = np.random.default_rng(3)
    likelihood = draw.random((40, 3)) + 0.01
    shares, value = languages._mixture(likelihood, np.zeros(40, int), np.array([40]), np.ones((1, 3)))
    assert np.isclose(shares.sum(), 1)
    for _ in range(300):
        other = draw.dirichlet(np.ones(3))
        assert np.log(likelihood @ other).sum() <= value[0] + 0.05


def test_quality_of_held_out_documents(spark, sf):
    rows = {r["doc_id"]: r for r in queries.op10_quality(spark, LARGE).collect()}
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", "quality").collect()
    assert all(r["held_out"] == (crc(k, 5) == 0) and 0 <= r["score"] <= 1 for k, r in rows.items())
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    good = [rows[r[0]]["score"] for r in labels if r[1] == 1 and rows[r[0]]["held_out"]]
    bad = [rows[r[0]]["score"] for r in labels if r[1] == 0 and rows[r[0]]["held_out"]]
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None]) > 0.97
    assert np.mean([s >= 0.3 for s in good] + [s < 0.3 for s in bad]) > 0.95


def test_a_sample_has_no_more_rows_than_ids(spark):
    docs = spark.range(100_000).selectExpr("7L doc_id", "cast(concat('some words ', id % 3) as binary) text").union(
        spark.range(3).selectExpr("id doc_id", "cast('other words' as binary) text")
    )
    ids = quality._sample(docs, 3)
    assert quality._matrix(docs, ids).shape[0] == 3
    again = quality._matrix(docs.repartition(5), ids)
    assert sorted(map(bytes, again)) == sorted(map(bytes, quality._matrix(docs, ids)))


def test_quality_of_odd_tables(spark, odd):
    docs = odd(["Some words, and more of them.", None, "", "%% %% %% %%", "a " * 50_000])
    labels = spark.createDataFrame([(0, 1), (0, 1), (None, 1), (1, None), (2, 0)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    scores = [r["score"] for r in quality.score(docs, model).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    alone = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score(docs, alone).collect()} == {quality.UNKNOWN}
    assert quality.score(odd([]), model).count() == 0
    assert quality.fit(odd([]), labels, F.lit(True)).score([b"x"]) == [quality.UNKNOWN]


def test_risk_is_not_driven_below_zero():
    draw = np.random.default_rng(0)
    size = quality.SIZE
    good, bad = draw.normal(1, 1, (200, size)), draw.normal(-1, 1, (200, size))
    unlabelled = np.concatenate([draw.normal(1, 1, (200, size)), draw.normal(-1, 1, (200, size))])
    model = quality.risk_minimiser(good.astype(np.float32), unlabelled.astype(np.float32), 0.5)
    assert np.mean(good @ model.weights + model.bias > 0) > 0.95 and np.mean(bad @ model.weights + model.bias < 0) > 0.95
