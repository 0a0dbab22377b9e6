"""Near-duplicates by SimHash fingerprints and BK-trees.

Two fingerprints that differ in at most ``radius`` bits agree on some ``bands - radius`` of the bands that the
64 bits are cut into. Fingerprints are therefore dealt into one shard for every such choice of bands and every value of
them, and only meet inside shards. A shard is cut into blocks of bounded size; for every two blocks a BK-tree
of one (children keyed by their integer Hamming distance to the parent) is searched for the members of the
other, following only edges within the radius. A search leaves a spanning star of what it linked, not all
pairs. The trees are built where their shard lies, instead of being sent to every task.

``proposals`` links sets by wide fingerprints, for a similarity at which 64 bits tell too little and an exact check follows.
A fingerprint has 64 bits for each of several hashes of a shingle. Its bits are cut into bands, a shard is what agrees on one
band, and for every two blocks of a shard a BK-tree over the first ``COMPARED`` words of one is searched for the other. At that
radius few edges are left out, so that nodes are compared with all queries that reach them at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Staging, as_bytes, pieces, schema, staged
from tidemark.llm.components import connected
from tidemark.llm.recompression import mixed

SEED = 42
BLOCK = 512  # fingerprints in a block on average
SHARD = 4096  # expected fingerprints in a shard, above which more bands are used
WORK = 400_000  # pairs of tree node and query at most that a vectorised search may hold
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ROWS = 65_536  # shingles whose bits are counted at once
# Wide fingerprints. Sets of Jaccard similarity 0.8 differ in a bit with probability 0.1515 if both are large, else 0.1611 at the
# most, but 0.1875 for 4 of 5 shingles; with these figures they are missed with probability 3e-6, 4e-5 and 1.4e-4.
APART, MISSED = 0.1875, 5e-5
COMPARED, RADIUS, FIRST_RADIUS = 8, 117, 25  # words compared, bits of them that may differ, and bits of the first
SMALL, SMALL_RADIUS = 5, 131  # two sets of at most so many hashes may differ in more bits
WAVE = 48  # bands that are dealt into shards at once
WIDE_BLOCK = 2048  # wide fingerprints in a block on average
PAIRS = 1 << 18  # pairs found that are kept before they become stars
MET = 1 << 15  # pairs of node and query that are compared at once


def fingerprint(text: bytes | None, shingle: int) -> int:
    """A bit is set if it is set in over half the hashes of the word shingles, repeats included."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), ROWS):
        octets = hashes[i : i + ROWS].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint bigint), one for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), as_bytes(text_column).alias("text"))
    return chosen.mapInArrow(run, schema(chosen, "fingerprint bigint"))


def band_masks(n: int, radius: int) -> list[int]:
    """Bit masks of which any two fingerprints within the radius agree on one: as few as keep the expected
    shard small for ``n`` fingerprints."""
    for bands in range(radius + 1, 2 * radius + 3):
        edges = [round(64 * i / bands) for i in range(bands + 1)]
        parts = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:], strict=False)]
        masks = [sum(some) for some in combinations(parts, bands - radius)]
        if n >> min(m.bit_count() for m in masks) <= SHARD:
            break
    return masks


class Forest:
    """BK-trees of many groups at once. ``groups`` is sorted; values are distinct within a group."""

    def __init__(self, groups: np.ndarray, values: np.ndarray) -> None:
        n = len(values)
        self.values = values
        roots = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, np.int64)
        self.root = dict(zip(groups[roots].tolist(), roots.tolist(), strict=True))
        self.child = np.full(n * 65, -1, np.int64)  # by node and distance
        at = roots[np.searchsorted(roots, np.arange(n), side="right") - 1]
        rest = np.setdiff1d(np.arange(n), roots)
        at = at[rest]
        while len(rest):
            slot = at * 65 + np.bitwise_count(values[rest] ^ values[at])
            free = np.flatnonzero(self.child[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            self.child[taken] = rest[free[first]]
            at = self.child[slot]
            going = at != rest
            rest, at = rest[going], at[going]

    def within(self, groups: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, node index) at most ``radius`` apart, from the trees of the queries' groups."""
        node = np.array([self.root.get(g, -1) for g in groups.tolist()], np.int64)
        query = np.flatnonzero(node >= 0)
        node = node[query]
        steps = np.arange(-radius, radius + 1)
        found_q, found_n = [], []
        while len(query):
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            found_q.append(query[near])
            found_n.append(node[near])
            key = distance[:, None] + steps
            child = np.where((key > 0) & (key < 65), self.child[(node[:, None] * 65 + np.clip(key, 0, 64))], -1)
            which, _ = hit = np.nonzero(child >= 0)
            query, node = query[which], child[hit]
        return np.concatenate([*found_q, np.zeros(0, np.int64)]), np.concatenate([*found_n, np.zeros(0, np.int64)])


def _stars(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every value to the smallest it is connected with by the pairs (a, b) of indices."""
    nodes, ends = np.unique(np.concatenate([values[a], values[b]]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Rows (u, v) that connect exactly the distinct fingerprints of column ``fingerprint`` that a chain of
    pairs within the radius connects."""
    masks = band_masks(distinct.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys: Column = F.posexplode(F.array(*(F.col("fingerprint").bitwiseAND(F.lit(m)) for m in signed))).alias("band", "value")
    members = distinct.select("fingerprint", keys)
    sizes = staged(members.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1"), "shards")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.join(sizes, ["band", "value"]).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("fingerprint"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = ["band", "value", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    held = F.struct((F.col("block") < F.col("other")).alias("tree"), (F.col("block") == F.col("other")).alias("own"), "fingerprint")
    grouped = placed.groupBy(*pair).agg(F.collect_list(held).alias("held")).select("held")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            sizes = np.asarray(lists.value_lengths())
            flat = lists.flatten()
            tree, own = (np.asarray(flat.field(k)) for k in ("tree", "own"))
            values = np.asarray(flat.field("fingerprint")).view(np.uint64)
            ends = np.cumsum(sizes)
            load = np.cumsum(sizes.astype(np.int64) ** 2) // WORK
            cuts = np.flatnonzero(np.diff(load, append=-1))  # last group of each part
            start = 0
            for last in cuts.tolist():
                lo, hi = (ends[start - 1] if start else 0), ends[last]
                part, group = slice(lo, hi), np.repeat(np.arange(start, last + 1), sizes[start : last + 1])
                start = last + 1
                in_tree, asks = tree[part] | own[part], ~tree[part] | own[part]
                v = values[part]
                forest = Forest(group[in_tree], v[in_tree])
                q, n = forest.within(group[asks], v[asks], radius)
                both = np.concatenate([v[asks], v[in_tree]])
                n = n + int(asks.sum())
                apart = both[q] != both[n]
                u, w = _stars(both, q[apart], n[apart])
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(w.view(np.int64))], ["u", "v"])

    return grouped.mapInArrow(search, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint bigint, component_id): documents linked, over any number of steps, by
    fingerprints at most ``radius`` bits apart; the component is named by its smallest doc_id.

    Words are split at ASCII white space after lower-casing A-Z. A text of fewer words than a shingle has one
    shingle; a null or empty text has fingerprint zero and is linked like any other. Repeated rows give a
    row each. A null id is kept; a component of null ids only is null. Other columns are not looked at. An
    empty table gives no rows.
    """
    marked = staged(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    distinct = staged(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    linked = connected(links(distinct, radius)).withColumnsRenamed({"node": "fingerprint"})
    members = staged(distinct.join(linked, "fingerprint"), "members")
    named = staged(members.groupBy("component").agg(F.min("first").alias("component_id")), "named")
    found = members.join(named, "component").select("fingerprint", "component_id")
    every = distinct.join(found, "fingerprint", "left")
    every = staged(every.select("fingerprint", F.coalesce("component_id", "first").alias("component_id")), "classes")
    return marked.join(every, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hexadecimal(fingerprint_column: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_column), 16, "0"))


def layout(n: int) -> tuple[int, int]:
    """Bits of a band, and the number of bands, for ``n`` sets: bands as wide as keep the expected shard small, and as many as
    find a pair at the least similarity."""
    bits = 8
    while n >> bits > SHARD and bits < 16:
        bits += 1
    return bits, ceil(log(MISSED) / log1p(-((1 - APART) ** bits)))


def wide_fingerprints(sets: list[np.ndarray], words: int) -> np.ndarray:
    """A row of ``words`` times 64 bits for every set of hashes: a bit is set if it is set in over half of the members'
    hashes of its word. The empty set has zeros."""
    out = np.zeros((len(sets), words), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    every = np.concatenate([sets[i] for i in some])
    # at most 255 members are counted in the eight octets of an integer, a bit of each octet at a time
    parts = -(-sizes[some] // 255)
    first = np.cumsum(parts) - parts
    start = np.repeat(np.cumsum(sizes[some]) - sizes[some], parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    lanes = np.uint64(0x0101010101010101)
    for w in range(words):
        hashes = mixed(every ^ mixed(np.full(1, SEED + w, np.uint64)))
        counts = np.stack([np.add.reduceat((hashes >> np.uint64(b)) & lanes, start).view(np.uint8).reshape(-1, 8) for b in range(8)], axis=2)
        counts = np.add.reduceat(counts.astype(np.int64), first, axis=0)  # by octet and bit
        ones = 2 * counts.reshape(-1, 64) > sizes[some, None]
        out[some, w] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which the columns of two arrays of words differ."""
    total = np.bitwise_count(left[0] ^ right[0]).astype(np.int16)
    for a, b in zip(left[1:], right[1:], strict=True):
        total += np.bitwise_count(a ^ b)
    return total


class WideTree:
    """A BK-tree of fingerprints (rows of words): the children of a node are keyed by how many bits they are apart from it."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.words = np.ascontiguousarray(values.T)
        parent, edge = np.zeros(n, np.int64), np.zeros(n, np.int16)
        rest, at = np.arange(1, n), np.zeros(max(0, n - 1), np.int64)
        while len(rest):  # what shares a node goes on to the first of its distance, which becomes the child
            distance = _apart(self.words[:, rest], self.words[:, at])
            _, first, which = np.unique(at * (64 * len(self.words) + 1) + distance, return_index=True, return_inverse=True)
            child = rest[first]
            parent[child], edge[child] = at[first], distance[first]
            at = child[which]
            going = at != rest
            rest, at = rest[going], at[going]
        self.edge, self.children = edge, 1 + np.argsort(parent[1:], kind="stable")
        self.ends = np.searchsorted(parent[self.children], np.arange(n + 1))  # where the children of a node begin
        self.inner = np.diff(self.ends) > 0

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes, and for each the number of its node in the list."""
        counts = self.ends[nodes + 1] - self.ends[nodes]
        row = np.repeat(np.arange(len(nodes)), counts)
        return self.children[np.arange(len(row)) + (self.ends[nodes] - np.cumsum(counts) + counts)[row]], row

    def _leaves(self, leaves: np.ndarray, own: np.ndarray, asked: np.ndarray, radius: int, first: int, may: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        step = max(1, MET // len(asked))
        for at in range(0, len(leaves), step):
            some = leaves[at : at + step]
            near = np.bitwise_count(own[0] ^ self.words[0, some, None]) <= first
            y, x = np.nonzero(near if may is None else near & may[at : at + step])
            distance = _apart(own[:, x], self.words[:, some[y]])
            near = distance <= radius
            if near.any():
                yield asked[x[near]], some[y[near]], distance[near]

    def within(self, queries: np.ndarray, radius: int, first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Parts (query index, node index, distance) of the pairs at most ``radius`` apart, over edges within the radius of the distance
        only. A node without children is only looked at if at most ``first`` bits of the first word differ."""
        words = np.ascontiguousarray(queries.T)
        going = [(np.zeros(1, np.int64), np.arange(len(queries)))] if len(queries) and len(self.inner) else []
        while going:
            nodes, asked = going.pop()
            own, step = words if len(asked) == len(queries) else words[:, asked], max(1, MET // len(asked))
            if len(nodes) > step:
                going.append((nodes[step:], asked))
                nodes = nodes[:step]
            distance = _apart(own[:, None], self.words[:, nodes, None])
            y, x = np.nonzero(distance <= radius)
            if len(x):
                yield asked[x], nodes[y], distance[y, x]
            child, row = self.below(nodes)
            edge, leaf = self.edge[child], ~self.inner[child]
            whole = (edge - distance.min(axis=1)[row] <= radius) & (distance.max(axis=1)[row] - edge <= radius)  # every query goes on
            if (some := whole & ~leaf).any():
                going.append((child[some], asked))
            if (some := whole & leaf).any():
                yield from self._leaves(child[some], own, asked, radius, first, None)
            if (some := ~whole & leaf).any():
                yield from self._leaves(child[some], own, asked, radius, first, np.abs(distance[row[some]] - edge[some, None]) <= radius)
            for k in np.flatnonzero(~whole & ~leaf).tolist():
                reached = asked[np.abs(distance[row[k]] - edge[k]) <= radius]
                if len(reached):
                    going.append((child[k : k + 1], reached))


def _alike(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of every set of equal rows, and for every row the number of its set."""
    if len(np.unique(values[:, 0])) == len(values):
        return np.arange(len(values)), np.arange(len(values))
    _, first, which = np.unique(values, axis=0, return_index=True, return_inverse=True)
    return first, which.reshape(-1)


def wide_links(node: np.ndarray, values: np.ndarray, small: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the nodes of rows ``a`` with those of rows ``b`` whose fingerprints are within the radius, and equal ones."""
    (first_a, which_a), (first_b, which_b) = _alike(values[a]), _alike(values[b])
    few_a, few_b = np.zeros(len(first_a), bool), np.zeros(len(first_b), bool)
    few_a[which_a[small[a]]] = few_b[which_b[small[b]]] = True
    rows_a, rows_b = a[first_a], b[first_b]
    ends, pairs, held = [], [(a, rows_a[which_a]), (b, rows_b[which_b])], 0
    for x, y, distance in WideTree(values[rows_b]).within(values[rows_a], SMALL_RADIUS, FIRST_RADIUS):
        near = (distance <= RADIUS) | (few_a[x] & few_b[y])
        pairs.append((rows_a[x[near]], rows_b[y[near]]))
        held += len(x)
        if held > PAIRS:  # only a star of every part is kept, not its pairs
            ends.append(np.stack(_stars(node, *map(np.concatenate, zip(*pairs, strict=True)))))
            pairs, held = [], 0
    if pairs:
        ends.append(np.stack(_stars(node, *map(np.concatenate, zip(*pairs, strict=True)))))
    u, v = np.concatenate(ends, axis=1)
    return _stars(np.r_[u, v], np.arange(len(u)), len(u) + np.arange(len(u)))


def proposals(texts: DataFrame, members: Callable[[bytes | None], np.ndarray]) -> DataFrame:
    """Rows (u, v), staged, that connect the nodes of (node bigint, text binary) that a chain of pairs within the radius
    connects, which share a band. ``members`` gives the set of hashes of a text."""
    bits, bands = layout(texts.count())
    words = max(COMPARED, ceil(bands / (64 // bits)))
    stage = Staging(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [members(t) for t in batch.column(1).to_pylist()]
            found = wide_fingerprints(sets, words).view(np.int64)
            small = pa.array([len(s) <= SMALL for s in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), small, *(pa.array(c) for c in found.T)], ["node", "small", *names])

    names = [f"w{k}" for k in range(words)]
    marked = stage.put(texts.mapInArrow(run, ", ".join(["node bigint, small boolean", *(f"{c} bigint" for c in names)])), "wide-fingerprints")
    low = F.lit((1 << bits) - 1).cast("bigint")
    values = [F.shiftrightunsigned(c, b * bits).bitwiseAND(low) for c in names for b in range(64 // bits)]
    keys = [F.lit(k << 16).cast("bigint") + value for k, value in enumerate(values[:bands])]
    carried = ["node", "small", *names[:COMPARED]]
    # which side of the pair of blocks: 0 first, 1 second, 2 both
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")
    pair = [F.col("shard"), F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]

    def search(held: pa.Table) -> pa.Table:
        node, side, small = (held[c].to_numpy() for c in ("node", "side", "small"))
        values = np.stack([held[c].to_numpy().view(np.uint64) for c in names[:COMPARED]], axis=1)
        u, v = wide_links(node, values, small, np.flatnonzero(side != 1), np.flatnonzero(side != 0))
        return pa.table({"u": u, "v": v})

    found = []
    for at in range(0, len(keys), WAVE):  # one after the other, so that the exchange stays small beside the texts
        dealt = marked.select(*carried, F.explode(F.array(*keys[at : at + WAVE])).alias("shard"))
        sizes = stage.put(dealt.groupBy("shard").agg(F.count("*").alias("size")).where("size > 1"), "wide-shards")
        placed = dealt.join(sizes.select("shard", F.ceil(F.col("size") / WIDE_BLOCK).cast("int").alias("blocks")), "shard")
        placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        grouped = placed.select(*pair, side, *carried).groupBy("shard", "lo", "hi")
        found.append(staged(grouped.applyInArrow(search, "u bigint, v bigint").distinct(), "proposals"))
        stage.drop(sizes)
    stage.drop(marked)
    return reduce(DataFrame.union, found)
