import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import queries, recompression, substring_dedup


def brute_force(texts, size):
    cut = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    counts = collections.Counter(tuple(w[i : i + size]) for w in cut for i in range(len(w) - size + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if counts[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def texts(seed):
    draw = random.Random(seed)
    out = [None, "", " ", "x y " * 100, "x y " * 60, "a " * 500, "q " * 36, "A a " * 50]
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNéü"
    for _ in range(120):
        some = [draw.choice(alphabet[: draw.choice([1, 2, 3, 8, 42])]) for _ in range(draw.randint(0, 120))]
        if draw.random() < 0.4:
            other = (draw.choice(out) or "").split()
            i = draw.randint(0, len(other))
            some[draw.randint(0, len(some)) : 0] = other[i : i + draw.randint(5, 60)]
        out.append(draw.choice([" ", "\n", " \t "]).join(some))
    return [*out, out[20]]


@pytest.mark.parametrize("size", [35, 12, 5])
def test_small_cases_against_brute_force(odd, size):
    given = texts(size)
    found = substring_dedup.without_repeats(odd(given), window=size).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == sorted(brute_force(given, size))
    assert found[0]["doc"].__fields__ == odd([]).columns


def test_repeated_rows_and_empty_tables(odd):
    passage = " ".join(map(str, range(40)))
    rows = substring_dedup.without_repeats(odd([passage, passage, None, "short"], ids=[1, 1, None, 2])).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in rows) == [(0, 0), (1, 0), (40, 40), (40, 40)]
    assert substring_dedup.without_repeats(odd([])).count() == 0


def test_a_row_repeated_very_often(spark):
    """Under a null id; beside texts that share a part of it."""
    words = [f"w{i}" for i in range(60)]
    hot = spark.range(20_000).selectExpr("cast(null as bigint) doc_id", f"'{' '.join(words)}' text")
    others = spark.createDataFrame([(1, " ".join(["x", *words[5:50], "y"])), (2, "alone " * 20), (3, " ".join(f"v{i}" for i in range(80)))], "doc_id bigint, text string")
    rows = substring_dedup.without_repeats(hot.union(others)).select("doc.doc_id", "n_words", "n_removed").collect()
    assert sorted({tuple(r) for r in rows if r[0]}) == [(1, 47, 45), (2, 20, 0), (3, 80, 0)]
    assert {(r[1], r[2]) for r in rows if r[0] is None} == {(60, 60)} and len(rows) == 20_003


def test_the_query_on_all_documents(spark, sf, documents):
    rows = {r["doc_id"]: r for r in queries.op5_substring_dedup(spark, sf).collect()}
    removed = 0
    for (key, _), (n, gone, kept) in zip(documents, brute_force([t for _, t in documents], 35), strict=True):
        r = rows[key]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        removed += gone
    assert removed


def test_word_hashes_follow_the_words_alone(monkeypatch):
    given = [t and t.encode() for t in [*texts(3), "é\x00 \x1f\x85 a\x0bb" + "z" * 300]]
    both, end, begin = recompression.marked(given)
    words = [w for t in given for w in (t or b"").split()]
    seen = {}
    for w, h in zip(words, both[:, ~end].T.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len({h[0] for h in seen.values()}) == len({h[1] for h in seen.values()}) == len(seen)
    monkeypatch.setattr(recompression, "BYTES", 50)
    assert (recompression.marked(given)[0] == both).all()


def test_equal_windows_have_equal_anchors():
    draw = random.Random(7)
    given = [t and t.encode() for t in ["b b D a a a g c", *texts(7), "h c b a a b b D a a"]]
    both, end, begin = recompression.marked(given)
    for size in (5, 12, 35):
        name, first, last, place = recompression.anchors(both[0], end, size)
        seen = {}
        covered = 0
        assert (place >= last).all() and (place < first + size).all()
        for n, a, b in zip(name.tolist(), first.tolist(), last.tolist(), strict=True):
            for i in range(a, b + 1):
                assert seen.setdefault(both[0][i : i + size].tobytes(), n) == n
                covered += 1
        assert covered == sum(max(0, len((t or b"").split()) - size + 1) for t in given)
    prefixes = recompression.Prefixes(both[1])
    a = np.array([draw.randrange(len(end) - 40) for _ in range(50)])
    copied = recompression.Prefixes(np.concatenate([both[1][:3], both[1]]))
    assert (prefixes(a, a + 30) == copied(a + 3, a + 33)).all()
