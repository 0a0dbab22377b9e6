import collections
import math
import re

import pytest

from tidemark.llm import language_model, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut_up(texts):
    return [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) for t in texts]


def brute_force(texts, corpus=None):
    cut = cut_up(texts)
    counted = cut if corpus is None else cut_up(corpus)
    words = collections.Counter(w for some in counted for w in some)
    for w in {w for some in cut for w in some} - set(words):
        words[w] = 1
    pairs = collections.Counter(p for some in counted for p in zip(some, some[1:], strict=False))
    total, out = words.total(), []
    for some in cut:
        score = 0.0
        for i, w in enumerate(some):
            if i and pairs[some[i - 1], w]:
                score += math.log(pairs[some[i - 1], w] / words[some[i - 1]])
            else:
                score += math.log((0.4 if i else 1) * words[w] / total)
        out.append((len(some), round(score, 6)))
    return out


@pytest.mark.parametrize("hot", [100_000, 2, 0])
def test_small_cases(odd, monkeypatch, hot):
    monkeypatch.setattr(language_model, "HOT", hot)
    texts = [None, "", " x", "x", "a b a b A B", "a b", "q", "a b", "É a b é A\tb", "z " * 3000]
    rows = language_model.log_scores(odd(texts, ids=[0, 1, 2, None, 4, 5, 6, 5, 5, 9])).collect()
    assert sorted((r["n_words"], round(r["log_score"], 6)) for r in rows) == sorted(brute_force(texts))


@pytest.mark.parametrize("hot", [100_000, 2, 0])
def test_texts_under_the_counts_of_another_corpus(odd, monkeypatch, hot):
    """Pairs that the corpus lacks back off, also to words that it lacks."""
    monkeypatch.setattr(language_model, "HOT", hot)
    corpus = ["a b a b c", "b c b", None, "x", "c d"]
    texts = ["a b c", "b a d", "new a b", "", None, "c c c c", "new new", "x"]
    rows = language_model.log_scores(odd(texts, ids=list(range(8))), corpus=odd(corpus)).collect()
    assert sorted((r["n_words"], round(r["log_score"], 6)) for r in rows) == sorted(brute_force(texts, corpus))


def test_empty_table(odd):
    assert language_model.log_scores(odd([])).count() == 0


@pytest.mark.parametrize("hot", [100_000, 100])
def test_the_query_on_all_documents(spark, sf, documents, monkeypatch, hot):
    monkeypatch.setattr(language_model, "HOT", hot)
    rows = {r["doc_id"]: r for r in queries.op2_language_model(spark, sf).collect()}
    for (key, _), (n, score) in zip(documents, brute_force([t for _, t in documents]), strict=True):
        assert rows[key]["n_words"] == n and abs(rows[key]["log_score"] - score) < 0.001


def test_counts(odd):
    rows = language_model.count_table(odd(["a b a b", "a b", "c"])).collect()
    assert sorted((r["pair"], r["n"]) for r in rows) == [(False, 1), (False, 3), (False, 3), (True, 1), (True, 3)]


def test_parts_are_exchanged_apart(spark, odd, monkeypatch):
    """What one exchange holds is a part of the n-grams, and the parts together are every n-gram once."""
    docs = odd([" ".join(f"w{(i * k) % 97}" for k in range(60)) for i in range(1, 40)], ids=list(range(39)))
    monkeypatch.setattr(language_model, "HOT", 2)
    keyed = docs.selectExpr("doc_id AS k1", "doc_id AS k2", "CAST(text AS BINARY) AS text")
    shared, total = language_model._shared(language_model.count_table(docs, least=2))

    def rows(parts):
        return [[tuple(r) for r in language_model._needed(keyed, shared, total, p, parts).collect()] for p in range(parts)]

    (whole,), several = rows(1), rows(3)
    assert sorted(sum(several, [])) == sorted(whole)
    assert all(0.2 < len(p) / len(whole) < 0.5 for p in several)


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_number_of_parts_gives_the_same(odd, monkeypatch, parts):
    monkeypatch.setattr(language_model, "HOT", 1)
    monkeypatch.setattr(language_model, "PARTS", parts)
    texts = [None, "", "a b a b A B", "a b", "q", "q r s", "É a b é A\tb", "z " * 300]
    rows = language_model.log_scores(odd(texts, ids=list(range(8)))).collect()
    assert sorted((r["n_words"], round(r["log_score"], 6)) for r in rows) == sorted(brute_force(texts))
