import hashlib
import random
import re

import numpy as np

from tidemark.llm import decontamination, fm_index, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute_force(texts, items, window=10):
    """For each text: words, hit word numbers, ids of items."""
    windows = {}
    for item, text in items:
        if item is None:
            continue
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= owners
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def as_brute(row):
    hit = [i for s in row["spans"] for i in range(s["first"], s["last"] + 1)]
    return row["n_words"], hit, sorted(row["item_ids"])


def cases():
    draw = random.Random(4)
    letters = "abcdefg"
    items = [(i, " ".join(draw.choices(letters, k=draw.randint(0, 16)))) for i in range(30)]
    items += [(30, "Only, four WORDS here"), (31, ""), (32, None), (None, "lost words"), (5, items[5][1]), (33, items[5][1]), (34, "É à ß 1 2 3 4 5 6 7 8")]
    texts = [None, "", "...", "only four-words HERE and only four words here", "x é à ß 1 2 3 4 5 6 7 8 9", "a " * 300]
    for _ in range(60):
        some = [draw.choice(letters) for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(some))
            some[at:at] = (draw.choice(items)[1] or "").split()
        texts.append(draw.choice([" ", ", ", "\n"]).join(some))
    return texts, items


def test_small_cases_against_brute_force(spark, odd, monkeypatch):
    texts, items = cases()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find(odd(texts), benchmark).collect()
    key = lambda r: (r["doc"]["text"] is None, r["doc"]["text"] or "", r["doc"]["doc_id"] or -1)
    expected = dict(zip(texts, brute_force(texts, items), strict=True))
    assert len(found) == len(texts)
    assert all(as_brute(r) == expected[r["doc"]["text"]] for r in sorted(found, key=key))
    # the same in many blocks of items
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    again = decontamination.find(odd(texts), benchmark).collect()
    assert all(as_brute(r) == expected[r["doc"]["text"]] for r in again)


def test_shards_smaller_than_a_text(monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD", 37)
    texts, items = cases()
    texts = [" ".join(t or "" for t in texts), *texts]
    phrases = decontamination.Phrases([(str(i), (t or "").encode()) for i, t in items if i is not None], 10)
    sizes, hit, pairs = decontamination._occurrences([t and t.encode() for t in texts], phrases)
    start = 0
    for k, (n, hits, found) in enumerate(brute_force(texts, items)):
        assert n == sizes[k] and np.flatnonzero(hit[start : start + n]).tolist() == hits
        assert sorted(phrases.items[i] for d, i in pairs.tolist() if d == k) == found
        start += n + 1


def test_cleaned_texts(spark, odd):
    benchmark = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id bigint, text string")
    texts = ["a, ONE two-three. b", None, "one two", "one two three", ""]
    cleaned = decontamination.clean(odd(texts), benchmark)
    assert cleaned.columns == odd(texts).columns
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert got == {0: "a, . b", 1: None, 2: "one two", None: "", 4: ""}


def test_empty_tables(spark, odd):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontamination.find(odd(["a b", None]), nothing).collect()
    assert [as_brute(r) for r in rows] == [(2, [], []), (0, [], [])]
    assert decontamination.find(odd([]), nothing).count() == 0


def test_the_query_on_all_documents(spark, sf, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r["doc_id"]: r for r in queries.op3_decontamination(spark, sf).collect()}
    found = 0
    for (key, _), (n, hits, ids) in zip(documents, brute_force([t for _, t in documents], items), strict=True):
        r = rows[key]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, len(hits), len(ids), digest, bool(hits))
        found += bool(hits)
    assert found


def test_index_counts_and_locates():
    draw = np.random.default_rng(1)
    symbols = np.r_[draw.integers(0, 4, 500), np.tile([1, 2], 60), 0]
    index = fm_index.FMIndex(symbols, 4)
    for size in (1, 2, 5):
        phrases = draw.integers(1, 4, (40, size))
        which, lo, hi = index.search(phrases)
        seen = dict(zip(which.tolist(), zip(lo.tolist(), hi.tolist(), strict=True), strict=True))
        for k, p in enumerate(phrases):
            places = [i for i in range(len(symbols) - size + 1) if (symbols[i : i + size] == p).all()]
            at = index.locate(np.arange(*seen.get(k, (0, 0))))
            assert sorted(at.tolist()) == places
