import random
import re

import numpy as np
import xxhash

from tidemark.llm import queries, simhash
from tidemark.llm.components import connected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, size=4):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=4):
    """Index of the first member of every value's component."""
    values, root = np.array(values, np.uint64), list(range(len(values)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values[a] ^ values) <= radius):
            x, y = find(a), find(int(b))
            root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(values))]


def test_the_query_on_all_documents(spark, sf, documents):
    ids = sorted(documents, key=lambda d: d[0])
    prints = [fingerprint(t) for _, t in ids]
    expected = {
        k: (format(p, "016x"), ids[c][0]) for (k, _), p, c in zip(ids, prints, classes(prints), strict=True)
    }
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash(spark, sf).collect()}
    assert got == expected and any(c != k for k, (_, c) in got.items())


def test_odd_texts(odd):
    texts = [None, "", " \t\n", "one", "One", "a b c", "A  B\nC", "a b c d", "a b c d", " x", "x " * 5000, "x " * 4000]
    ids = [5, 3, 3, None, 9, 8, 7, 6, 6, 11, 12, None]
    rows = simhash.near_duplicates(odd(texts, ids)).collect()
    prints = [fingerprint(t) for t in texts]
    roots = classes(prints)
    first = {r: min((i for i, c in zip(ids, roots, strict=True) if c == r and i is not None), default=None) for r in roots}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    expected = [(i, p, first[c]) for i, p, c in zip(ids, signed, roots, strict=True)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert simhash.near_duplicates(odd([])).count() == 0


def near(draw, centre, n, most):
    out = set()
    while len(out) < n:
        v = centre
        for b in draw.sample(range(64), draw.randint(0, most)):
            v ^= 1 << b
        out.add(v)
    return out


def test_dense_and_sparse_fingerprints(spark, monkeypatch):
    draw = random.Random(2)
    values = {draw.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    values |= near(draw, draw.getrandbits(64), 150, 5) | near(draw, draw.getrandbits(64), 60, 3)
    values = sorted(values)
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint bigint")
    expected = classes(values)
    for block, work in ((512, 400_000), (16, 300)):  # small blocks: every shard is cut
        monkeypatch.setattr(simhash, "BLOCK", block)
        monkeypatch.setattr(simhash, "WORK", work)
        linked = {r["node"] & (1 << 64) - 1: r["component"] & (1 << 64) - 1 for r in connected(simhash.links(table, 4)).collect()}
        groups = {}
        for v, c in zip(values, expected, strict=True):
            groups.setdefault(c, []).append(v)
        for members in groups.values():
            assert len({linked.get(v, v) for v in members}) == 1 and all((v in linked) == (len(members) > 1) for v in members)
        assert len({linked.get(v, v) for v in values}) == len(groups)


def test_band_masks_leave_no_pair_apart():
    draw = random.Random(3)
    for n in (10, 10**6, 10**9, 10**11):
        masks = simhash.band_masks(n, 4)
        assert n >> min(m.bit_count() for m in masks) <= simhash.SHARD
        for _ in range(300):
            flips = sum(1 << b for b in draw.sample(range(64), 4))
            assert any(not flips & m for m in masks)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 180)] + [(300, 300), (None, 1), (7, 6)]
    got = {r[0]: r[1] for r in connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in [*range(100, 180), 200]}}
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_wide_trees_find_all_within_the_radius():
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 1 << 64, (30, 8), np.uint64)
    flips = np.packbits(draw.random((600, 512)) < draw.choice([0.0, 0.02, 0.1, 0.2], 600)[:, None], axis=1).view(np.uint64)
    values = centres[draw.integers(0, 30, 600)] ^ flips
    apart = np.bitwise_count(values[:, None] ^ values).sum(axis=2, dtype=np.int64)
    for radius in (0, 20, 117, 512):
        for nodes, asks in ((slice(0, 600), slice(0, 600)), (slice(0, 300), slice(300, 600)), (slice(0, 1), slice(0, 9)), (slice(0, 0), slice(0, 9))):
            found = list(simhash.WideTree(values[nodes]).within(values[asks], radius, 64))
            got = sorted((int(q), int(n), int(d)) for part in found for q, n, d in zip(*part, strict=True))
            assert got == sorted((q, n, int(d)) for (q, n), d in np.ndenumerate(apart[asks, nodes]) if d <= radius)


def test_a_wide_tree_keys_children_by_distance():
    draw = np.random.default_rng(4)
    values = draw.integers(0, 1 << 64, (500, 8), np.uint64)
    tree = simhash.WideTree(values)
    for node in range(500):
        child, _ = tree.below(np.array([node]))
        assert len(set(tree.edge[child].tolist())) == len(child)
        assert (np.bitwise_count(values[child] ^ values[node]).sum(axis=1) == tree.edge[child]).all()
    assert [len(p[0]) for p in tree.within(values[:1], 0, 0)] == [1]


def test_the_proposals_are_searched_by_trees(spark, monkeypatch):
    """Fails where blocks are compared pair by pair."""
    draw = np.random.default_rng(5)
    values = draw.integers(0, 1 << 64, (300, 8), np.uint64)
    values[100:200] = values[:100]  # equal ones
    values[200:250] ^= np.uint64(7)
    values[250] = values[200] ^ np.uint64(8)
    node, small = draw.permutation(300), np.zeros(300, bool)
    made, init = [], simhash.WideTree.__init__
    monkeypatch.setattr(simhash.WideTree, "__init__", lambda self, v: (made.append(len(v)), init(self, v))[1])
    monkeypatch.setattr(simhash, "PAIRS", 10)
    u, v = simhash.wide_links(node, values, small, np.arange(300), np.arange(300))
    assert made == [200]
    want = {frozenset((int(node[i]), int(node[i + 100]))) for i in range(100)} | {frozenset((int(node[200]), int(node[250])))}
    assert {frozenset(p) for p in zip(u.tolist(), v.tolist(), strict=True)} == want
