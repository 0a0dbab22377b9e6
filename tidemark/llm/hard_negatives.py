"""Hard negatives by coordinate pruning in buckets of similar length (after LEMP; Teflioudi, Gemulla and Mykytiuk, 2015).

Vectors of a label are bucketed by length, in buckets of bounded size. A bucket holds its vectors and, for every coordinate, the
order of its normalised values. An anchor that looks for products of at least t needs a cosine of at least t / (its
length x the bucket's longest) there. Where that exceeds 1 the bucket is skipped. Otherwise every coordinate of a candidate
must lie in a range around the anchor's own; the ranges of the anchor's largest coordinates, its focus, are looked up
in the sorted lists, and what lies in all of them is verified by exact integer products.

Anchors of a label travel in chunks of bounded size, which meet the buckets in two waves: the first over the longest vectors of each
label gives every anchor a k-th best score, which is the least that the second wave, over all the others, looks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

BUCKET = 2048  # vectors of a bucket on average
CHUNK = 128  # anchors of a chunk on average
BAND = 1.1  # the longest of a band by its shortest
FOCUS = 6  # coordinates whose ranges are intersected
DENSE = 0.2  # share of candidates from which on products of all with all are cheaper
MARGIN = 1e-9  # for rounding, of cosines
EXACT = float(1 << 53)  # below which sums of products of integers are exact as doubles
CELLS = 64  # parts that buckets without a label in common are dealt into

FOUND = "row bigint, anchor_id bigint, slot int, vec_id bigint, score bigint"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with those of ``b``."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by their lengths, zeros as they are; and the lengths."""
    x = vectors.astype(np.float64)
    lengths = np.sqrt((x * x).sum(1))
    return x / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def sorted_lists(vectors: np.ndarray) -> np.ndarray:
    """For every coordinate, the numbers of the vectors in the order of its normalised values."""
    return np.argsort(unit(vectors)[0], axis=0, kind="stable").T.astype(np.int32)


def feasible(cosines: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest value of a coordinate of any unit vector whose cosine with one that has the value
    ``own`` there is at least ``cosines``: the rest of both has at most the product of what length is left."""
    around = np.arccos(np.clip(cosines - MARGIN, -1.0, 1.0))
    at = np.arccos(np.clip(own, -1.0, 1.0))
    return np.cos(np.minimum(np.pi, at + around)) - MARGIN, np.cos(np.maximum(0.0, at - around)) + MARGIN


def candidates(anchors: np.ndarray, least: np.ndarray, vectors: np.ndarray, lists: np.ndarray, longest: float) -> np.ndarray:
    """Which vectors of a bucket (columns) may have a product of at least ``least`` with each anchor (rows)."""
    normal, lengths = unit(anchors)
    bucket = unit(vectors)[0]
    out = np.ones((len(anchors), len(vectors)), bool)
    reach = lengths * longest
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, least / reach, np.where(least > 0, np.inf, -np.inf))
    out[cosine > 1 + MARGIN] = False
    pruned = np.flatnonzero((cosine > 0) & (cosine <= 1 + MARGIN))  # a cosine of 0 or less excludes nothing worth a look-up
    focus = np.argsort(-np.abs(normal[pruned]), axis=1, kind="stable")[:, :FOCUS]
    for a, coordinates in zip(pruned.tolist(), focus.tolist(), strict=True):
        low, high = feasible(cosine[a], normal[a, coordinates])
        inside = np.zeros(len(vectors), np.int8)
        for c, lo, hi in zip(coordinates, low, high, strict=True):
            order = lists[c]
            values = bucket[order, c]
            inside[order[np.searchsorted(values, lo) : np.searchsorted(values, hi, side="right")]] += 1
        out[a] = inside == len(coordinates)
    return out


def best(
    anchors: tuple[np.ndarray, np.ndarray, np.ndarray, list], bucket: tuple[np.ndarray, np.ndarray, np.ndarray, float], k: int
) -> Iterator[tuple[int, int, int, int, int]]:
    """Rows FOUND: for every slot (number, least, greatest score) of every anchor (rows, ids, vectors, slots) its k best in a
    bucket (ids, vectors, lists, longest) within these bounds; all that tie with the last are cut by the smaller id."""
    rows, own, vectors, slots = anchors
    ids, others, lists, longest = bucket
    least = np.array([min(s[1] for s in some) for some in slots], np.float64)
    may = candidates(vectors, least, others, lists, longest)
    dense = np.flatnonzero(may.mean(1) > DENSE)
    scores = dict(zip(dense.tolist(), products(vectors[dense], others), strict=True))
    for a in np.flatnonzero(may.any(1)).tolist():
        at = np.flatnonzero(may[a])
        score = scores[a][at] if a in scores else products(vectors[a : a + 1], others[at])[0]
        good = (ids[at] != own[a]) & (score >= min(s[1] for s in slots[a]))
        at, score = ids[at[good]], score[good]
        order = np.lexsort((at, -score))
        at, score = at[order], score[order]
        for number, low, high in slots[a]:
            first = int(np.searchsorted(-score, -high))  # scores fall
            for i in range(first, min(first + k, len(score))):
                if score[i] < low:
                    break
                yield int(rows[a]), int(own[a]), number, int(at[i]), int(score[i])


class Index:
    """Buckets of the rows (row, vec_id, label, vector): (label, size, bucket, longest, ids, vectors, lists), and whether a
    bucket is the first of its label, with its longest vector."""

    def __init__(self, rows: DataFrame) -> None:
        length = F.sqrt(square("vector"))
        band = F.when(length > 0, F.floor(F.log(length) / float(np.log(BAND)))).otherwise(-1).cast("int")
        placed = rows.select("row", "vec_id", "label", "vector", F.size("vector").alias("size"), length.alias("length"), band.alias("band"))
        key = ["label", "size", "band"]
        parts = placed.groupBy(*key).agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("parts"))
        placed = placed.join(staged(parts, "bands"), key).withColumn("part", F.pmod(F.xxhash64("row", F.lit(7)), "parts").cast("int"))
        packed = placed.groupBy(*key, "part").agg(F.collect_list(F.struct("vec_id", "vector")).alias("rows"), F.max("length").alias("longest"))
        packed = packed.withColumn("bucket", F.xxhash64(*key, "part"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    some = batch.column(5)[i].values
                    ids, vectors = np.asarray(some.field("vec_id"), np.int64), matrix(some.field("vector"))
                    made = [ids.tobytes(), vectors.tobytes(), sorted_lists(vectors).tobytes()]
                    columns = [*(batch.column(j).slice(i, 1) for j in range(5)), *(pa.array([x], pa.binary()) for x in made)]
                    yield pa.RecordBatch.from_arrays(columns, names)

        names = ["label", "size", "part", "bucket", "longest", "ids", "vectors", "lists"]
        packed = packed.select("label", "size", "part", "bucket", "longest", "rows")
        types = f"label {rows.schema['label'].dataType.simpleString()}, size int, part int, bucket bigint, longest double"
        built = staged(packed.mapInArrow(run, f"{types}, ids binary, vectors binary, lists binary"), "buckets")
        top = built.groupBy("label", "size").agg(F.max(F.struct("longest", "bucket"))["bucket"].alias("top"))
        top = staged(top, "longest").withColumnsRenamed({"label": "top_label", "size": "top_size"})
        here = F.col("label").eqNullSafe(F.col("top_label")) & (F.col("size") == F.col("top_size"))
        self.buckets = built.join(top, here).withColumn("first", F.col("bucket") == F.col("top"))


def square(vector: str) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x)


def matrix(lists: pa.Array) -> np.ndarray:
    flat = np.asarray(lists.flatten(), np.int64)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def _chunks(asked: DataFrame) -> DataFrame:
    """Anchors (row, vec_id, label, vector, slots) of a label in chunks, with the least length of a bucket that may help."""
    key = [F.col("label").alias("asked_label"), F.size("vector").alias("asked_size")]
    counted = staged(asked.groupBy(*key).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts")), "chunks")
    near = asked.join(counted, F.col("label").eqNullSafe(F.col("asked_label")) & (F.size("vector") == F.col("asked_size")))
    length = F.sqrt(square("vector"))
    least = F.array_min(F.transform("slots", lambda s: s["low"])).cast("double")
    need = F.when(least <= 0, 0.0).when(length > 0, least / length).otherwise(float("inf"))
    row = F.struct("row", "vec_id", "vector", "slots")
    part = F.pmod(F.xxhash64("row", F.lit(11)), "parts").alias("chunk")
    near = near.withColumn("need", need * (1 - MARGIN))
    return near.groupBy("asked_label", "asked_size", part).agg(F.collect_list(row).alias("asked"), F.min("need").alias("need"))


def _wave(index: Index, asked: DataFrame, same: bool, first: bool, k: int) -> DataFrame:
    """Rows FOUND of the buckets of one wave. Chunks meet the buckets of their label by the label; other buckets are
    dealt into cells, to which every chunk goes: a stated set of anchors against all rows, in blocks. There is a copy of the chunks for
    every cell, which the optimizer takes for one; the cells are therefore merged, as a broadcast would take all copies through the driver."""
    chunks = _chunks(asked)
    buckets = index.buckets.where(F.col("first") == first)
    fits = (F.col("size") == F.col("asked_size")) & (F.col("longest") >= F.col("need"))
    if same:
        met = chunks.join(buckets, F.col("label").eqNullSafe(F.col("asked_label")) & fits)
    else:
        chunks = chunks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1))))
        cell = F.pmod("bucket", F.lit(CELLS)).cast("int")
        met = chunks.hint("merge").join(buckets.withColumn("at_cell", cell), (F.col("cell") == F.col("at_cell")) & fits & (F.col("label") != F.col("asked_label")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                some = batch.column(0)[i].values
                vectors = matrix(some.field("vector"))
                slots = [[(s["slot"], s["low"], s["high"]) for s in x] for x in some.field("slots").to_pylist()]
                anchors = np.asarray(some.field("row"), np.int64), np.asarray(some.field("vec_id"), np.int64), vectors, slots
                ids = np.frombuffer(batch.column(2)[i].as_py(), np.int64)
                others = np.frombuffer(batch.column(3)[i].as_py(), np.int64).reshape(len(ids), vectors.shape[1])
                lists = np.frombuffer(batch.column(4)[i].as_py(), np.int32).reshape(vectors.shape[1], len(ids))
                found = list(best(anchors, (ids, others, lists, batch.column(1)[i].as_py()), k))
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "anchor_id", "slot", "vec_id", "score"])

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return met.select("asked", "longest", "ids", "vectors", "lists").mapInArrow(run, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def search(index: Index, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """Rows FOUND with a rank: for every slot of every anchor (row, vec_id, label, vector, slots), the k best rows of another id,
    of the same or of another label, whose scores lie between the slot's low and high."""
    early = staged(_top(_wave(index, asked, same, True, k), k), "first-wave")
    worst = early.groupBy("row", "slot").agg(F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") >= k)
    worst = worst.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("worst"))
    raised = lambda s: F.struct(s["slot"], F.coalesce(F.col("worst")[s["slot"]], s["low"]).alias("low"), s["high"])
    later = asked.join(worst, "row", "left").withColumn("slots", F.transform("slots", raised)).drop("worst")
    return _top(early.drop("rank").union(_wave(index, staged(later, "raised"), same, False, k)), k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100,
    id_column: str = "vec_id", label_column: str = "label", vector_column: str = "vector",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors, those rows that
    ``is_anchor`` holds for (an expression of vec_id).

    Scores are integer inner products. An anchor's positives are its ``positives`` best rows of the same label; to each of them
    belong the ``negatives`` best rows of other labels whose score is from ``least`` to ``most`` whole percents of the positive's. Fewer are given
    where there are fewer; ties go to the smaller id. A positive of negative score has no negatives.

    Vectors are arrays of integers, whose products must fit in 64 bits. Rows with a null id, label, vector or component take no
    part. Rows alike in id, label and vector count once; unlike rows of one id are rows of their own, and none is its
    id's candidate. Vectors of different dimensions do not meet. Other columns are not looked at. An empty table gives no rows.
    """
    given = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<bigint>").alias("vector"))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    given = given.where(whole).distinct().withColumn("row", F.xxhash64("vec_id", "label", "vector"))
    rows = staged(given, "vectors")
    index = Index(rows)
    anchors = rows.where(is_anchor)
    anywhere = F.struct(F.lit(0).alias("slot"), F.lit(-(2**63)).cast("bigint").alias("low"), F.lit(2**63 - 1).cast("bigint").alias("high"))
    liked = staged(search(index, anchors.withColumn("slots", F.array(anywhere)), True, positives), "positives")
    # of a positive score: div rounds towards 0
    low, high = F.expr(f"(score * {int(least)}L + 99) div 100").alias("low"), F.expr(f"(score * {int(most)}L) div 100").alias("high")
    slots = liked.where("score >= 0").select("row", F.struct(F.col("rank").alias("slot"), low, high).alias("slot"))
    slots = slots.groupBy("row").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    asked = staged(anchors.join(slots, "row"), "asked")
    found = search(index, asked, False, negatives)
    named = liked.select("row", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["row", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
