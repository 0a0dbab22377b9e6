"""Near-duplicates by the exact Jaccard similarity of word shingles.

SimHash fingerprints of the shingles only propose (``simhash.proposals``): texts whose fingerprints BK-trees find near each other
are linked, and the components of these links are candidate groups. Two texts at the least similarity 0.8 are not proposed with
probability 3e-6, texts of few shingles with up to 1.4e-4. Inside a candidate group every two texts are
compared by their whole sets of shingles. A group is cut into blocks of bounded size, and every two blocks meet in a task; a
block leaves a spanning star of what it linked, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, staged
from tidemark.llm.components import connected
from tidemark.llm.simhash import LOWER, SEED, _stars, proposals

WORDS, LEAST = 5, 0.8
BLOCK, BLOCK_BYTES = 256, 1 << 19  # texts and bytes of text in a block on average
COLUMNS = 2048  # shingles that are compared at once


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's word shingles. A text of fewer words has one shingle, one of no words none."""
    found = (text or b"").translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(words, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)), np.uint64, len(ends)))


def alike(left: list[np.ndarray], right: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose Jaccard similarity is ``least`` or more. Two empty sets are alike."""
    sets = [*left, *right]
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    keys, column = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    both = np.isin(keys, np.concatenate([np.zeros(0, np.uint64), *left])) & np.isin(keys, np.concatenate([np.zeros(0, np.uint64), *right]))
    place = np.where(both, np.cumsum(both) - 1, -1)[column]
    order = np.argsort(place, kind="stable")
    order = order[np.searchsorted(place[order], 0) :]
    place, owner = place[order], owner[order]
    shared = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(both.sum()), COLUMNS):
        lo, hi = np.searchsorted(place, (at, at + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[lo:hi], place[lo:hi] - at] = 1
        shared += (held[: len(left)] @ held[len(left) :].T).astype(np.int64)
    union = sizes[: len(left), None] + sizes[len(left) :] - shared
    return np.nonzero(shared >= least * union - 1e-9)


def _candidates(texts: DataFrame, words: int) -> DataFrame:
    """Rows (node, component) of texts that chains of near fingerprints connect."""
    return connected(proposals(texts, lambda text: shingles(text, words)))


def links(texts: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """Rows (u, v) that connect the texts of (node bigint, text binary), with unlike nodes, that a chain of pairs at
    least so similar connects."""
    groups = staged(_candidates(texts, words), "candidate-groups")
    held = staged(texts.join(groups, "node"), "candidate-texts")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES, F.lit(1))).cast("int").alias("blocks")
    sizes = staged(held.groupBy("component").agg(blocks), "candidate-sizes")
    placed = held.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = ["component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    # which side of the pair of blocks: 0 first, 1 second, 2 both
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    grouped = placed.groupBy(*pair).agg(F.collect_list(F.struct(side.alias("side"), "node", "text")).alias("held")).select("held")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.column(0)[i].values
                side, node = np.asarray(members.field("side")), np.asarray(members.field("node"))
                sets = [shingles(t, words) for t in members.field("text").to_pylist()]
                a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
                x, y = alike([sets[k] for k in a], [sets[k] for k in b], least)
                apart = a[x] != b[y]
                u, v = _stars(node, a[x[apart]], b[y[apart]])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return grouped.mapInArrow(search, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS, least: float = LEAST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, component_id): documents linked, over any number of steps, by pairs of texts whose sets of
    shingles of ``words`` words have a Jaccard similarity of ``least`` or more; the component is named by its
    smallest doc_id.

    Words are split at ASCII white space after lower-casing A-Z. A text of fewer words than a shingle has one
    shingle; texts without a word are alike. Equal texts are told by a 64-bit hash. Repeated rows give a row each.
    """
    marked = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(as_bytes(text_column), F.lit(b"")).alias("text"))
    marked = marked.withColumn("node", F.xxhash64("text"))
    texts = staged(marked.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("text").alias("text")), "texts")
    linked = staged(connected(links(texts.select("node", "text"), words, least)), "linked")
    members = staged(texts.select("node", "first").join(linked, "node"), "members")
    named = members.groupBy("component").agg(F.min("first").alias("component_id"))
    found = members.join(staged(named, "named"), "component").select("node", "component_id")
    every = texts.select("node", "first").join(found, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    return marked.select("doc_id", "node").join(staged(every, "classes"), "node").select("doc_id", "component_id")
