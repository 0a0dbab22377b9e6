import random
import re

import numpy as np

import corpus_pipeline
from tidemark.llm import jaccard, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def classes(texts):
    """Index of the first member of every text's component, from all pairs."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for b in range(len(sets)):
        for a in range(b):
            x, y = sets[a], sets[b]
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                shared = len(x & y)
                if 5 * shared >= 4 * (len(x) + len(y) - shared):
                    r, s = find(a), find(b)
                    root[max(r, s)] = min(r, s)
    return [find(a) for a in range(len(sets))]


def edited(draw, words, at):
    """Copies of a text of which single words differ, at about the similarity."""
    shingles_lost = (1 - at) / (1 + at) * len(words)
    words = list(words)
    for k in range(int(shingles_lost / 5)):
        words[7 + 11 * k] = f"edit{draw.random()}"
    return " ".join(words)


def made():
    draw, texts = random.Random(5), []
    for i in range(40):
        words = [f"w{i}x{draw.randrange(10**6)}" for _ in range(300)]
        texts += [" ".join(words), edited(draw, words, (0.74, 0.81, 0.84, 0.88)[i % 4])]
    hot = [f"hot{k}" for k in range(120)]
    texts += [edited(draw, hot, 0.8) for _ in range(60)]
    return [*texts, None, "", " \t", "one", "One", "a b c", "A  B\nC", "a b c d", texts[0].upper(), texts[3]]


def test_stage_finds_every_pair_from_0_8(spark, sf):
    """Fails for fingerprints of 4 words within 4 bits, which miss most pairs from 0.8 to 0.85."""
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(classes(texts)))


def test_small_blocks_give_the_same(spark, monkeypatch):
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert got == dict(enumerate(classes(texts)))
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_documents_against_all_pairs(spark, sf, documents):
    ids = sorted(documents, key=lambda d: d[0])
    roots = classes([t for _, t in ids])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({ids[r][0] for r in roots})


def test_boilerplate_makes_no_candidate_group(spark):
    """Texts at similarity 1/3 of each other. MinHash bands joined 590 of 2000 such texts."""
    draw = random.Random(3)
    common = " ".join(f"c{k}" for k in range(104))
    texts = [common + " " + " ".join(f"u{draw.random()}" for _ in range(100)) for _ in range(1000)]
    rows = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "node bigint, text binary")
    assert jaccard._candidates(rows, 5).count() < 20


def test_fingerprints_propose_what_is_similar(spark, monkeypatch):
    """Pairs at 0.8 to 0.85 are proposed by the fingerprints of the operator, in one and in several blocks and waves."""
    draw, texts = random.Random(7), []
    for i in range(600):
        words = [f"w{i}x{draw.randrange(10**6)}" for _ in range(8 + i)]
        texts += [" ".join(words), edited(draw, words, 0.83) if i % 2 else " ".join(words[: len(words) - (len(words) - 4) // 5])]
    roots = classes(texts)
    rows = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "node bigint, text binary")
    for block, wave in ((2048, 48), (4, 30)):
        monkeypatch.setattr(simhash, "WIDE_BLOCK", block)
        monkeypatch.setattr(simhash, "WAVE", wave)
        got = {(min(r), max(r)) for r in simhash.proposals(rows, jaccard.shingles).collect()}
        assert {(r, i) for i, r in enumerate(roots) if r != i} <= got and len(got) < 650


def test_wide_fingerprints_count_bits():
    draw = np.random.default_rng(1)
    sets = [draw.integers(0, 1 << 63, n, np.uint64) for n in (0, 1, 4, 254, 255, 256, 700)]
    got = simhash.wide_fingerprints(sets, 3)
    for s, row in zip(sets, got, strict=True):
        for w, value in enumerate(row.tolist()):
            hashes = simhash.mixed(s ^ simhash.mixed(np.full(1, simhash.SEED + w, np.uint64))).tolist()
            assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(s))


def test_layout_grows_with_the_table():
    assert [simhash.layout(n) for n in (0, 226_917, 15_000_000)] == [(8, 48), (8, 48), (12, 115)]
