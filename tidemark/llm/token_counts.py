"""Token counts without encoding most of the text.

A vocabulary string that the merges rebuild from its bytes as one token counts 1 wherever it is a whole
pre-token. Which strings do is proved once per vocabulary by a Spark job over the vocabulary; texts then
look their pre-tokens up and merge only the others.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, schema
from tidemark.llm.pretokens import Cutter

SHORT = 64  # symbols; shorter words are merged by scanning, longer ones with a heap


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in vocabulary files: a printable byte stands for itself, the
    others are numbered from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Byte strings, merges by rank and special strings of a byte-level BPE tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError("special tokens that strip or need word boundaries are not supported")
        letters = byte_alphabet()
        raw = lambda s: bytes(letters[c] for c in s)
        self.specials = [x["content"] for x in spec["added_tokens"]]
        self.strings = {raw(s): i for s, i in model["vocab"].items() if s not in self.specials}
        self.byte_ids = [self.strings[bytes([b])] for b in range(256)]
        ids = self.strings
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = map(raw, merge if isinstance(merge, list) else merge.split(" "))
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank, leftmost first, is merged until none is left."""
        ids = [self.byte_ids[b] for b in word]
        return _scan(ids, self.merges) if len(ids) <= SHORT else _heap(ids, self.merges)


def _scan(ids: list[int], merges: dict) -> list[int]:
    get = merges.get
    found = [get(p) for p in zip(ids, ids[1:], strict=False)]
    while True:
        best, at = None, -1
        for i, m in enumerate(found):
            if m is not None and (best is None or m[0] < best):
                best, at = m[0], i
        if at < 0:
            return ids
        ids[at : at + 2] = [found[at][1]]
        del found[at]
        if at:
            found[at - 1] = get((ids[at - 1], ids[at]))
        if at < len(found):
            found[at] = get((ids[at], ids[at + 1]))


def _heap(ids: list[int], merges: dict) -> list[int]:
    n = len(ids)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
    heapq.heapify(queue)
    while queue:
        _, i, a, b, made = heapq.heappop(queue)
        j = after[i]
        if j < 0 or ids[i] != a or ids[j] != b:
            continue  # one side was merged meanwhile
        ids[i], ids[j], after[i] = made, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (m := merges.get((ids[x], ids[y]))):
                heapq.heappush(queue, (m[0], x, ids[x], ids[y], m[1]))
    return [x for x in ids if x >= 0]


def prove(spark: SparkSession, vocabulary: Vocabulary) -> set[bytes]:
    """The vocabulary strings that encode alone as one token. As many rows as the vocabulary has."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = [s for s in batch.column(0).to_pylist() if len(shared.value.merge(s)) == 1]
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary())], ["string"])

    strings = spark.createDataFrame(pa.table({"string": pa.array(vocabulary.strings, pa.binary())}))
    return {bytes(r[0]) for r in strings.mapInArrow(whole, "string binary").collect()}


def count_tokens(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens): the UTF-8 bytes and the tokens of every text.

    Null and empty texts have 0 of both. Special strings inside a text count as one token each, as the
    tokenizer's own default has it. Repeated rows and repeated ids give a row each; a null id is kept. Other
    columns of ``docs`` are not looked at. An empty table gives no rows.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    shared = spark.sparkContext.broadcast((vocabulary, prove(spark, vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, proven = shared.value

        def solve(new: list[str]) -> list[int]:
            raw = [w.encode() for w in new]
            return [1 if w in proven else len(words.merge(w)) for w in raw]

        cutter = Cutter(pattern, solve, sum)
        split = words.specials and re.compile("|".join(map(re.escape, sorted(words.specials, key=len, reverse=True))))
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            parts = [split.split(t) if split else [t] for t in texts]
            totals = iter(map(sum, cutter.values([p for some in parts for p in some])))
            tokens = [sum(next(totals) for _ in some) + len(some) - 1 for some in parts]
            sizes = [n or 0 for n in pc.binary_length(batch.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(count, schema(chosen, "n_bytes bigint, n_tokens bigint"))
