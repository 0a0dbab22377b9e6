"""A training corpus from raw documents: language, near-duplicates, repeated passages, benchmarks, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, jaccard, languages, substring_dedup
from tidemark.llm.common import held_out, staged, table, whole_rows


def _with_text(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of documents with another text, and its number of characters."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return [(new[c] if c in new else F.col(f"{row}.`{c}`")).alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is recognised go: those without a letter, null and empty ones. Texts in several languages
    stay, however even their parts are. Null and repeated ids and repeated rows are kept as they are."""
    model = languages.fit(docs.where(languages.learnable(held_out("doc_id", 4, 2))))
    rows = languages.predict(docs.select(whole_rows(docs).alias("doc"), "text"), model, id_column="doc")
    kept = rows.where(F.col("lang_pred") != languages.NONE)
    return kept.select(*(F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by pairs of Jaccard similarity 0.8 or more of five-word shingles, the document of smallest
    id stays, null before others. Texts without words are one group. Of rows alike in id and text one stays, the first by
    its other columns as JSON."""
    mark = F.xxhash64("text")
    marked = docs.select(F.struct("doc_id", mark.alias("mark")).alias("row"), "text")
    groups = jaccard.near_duplicates(marked, id_column="row")
    firsts = groups.where("doc_id <=> component_id").select(F.col("doc_id.doc_id").alias("first_id"), F.col("doc_id.mark").alias("first_mark"))
    firsts = staged(firsts.distinct(), "first-of-groups")
    rest = F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")))
    rows = docs.select(whole_rows(docs).alias("doc"), F.col("doc_id").alias("own_id"), mark.alias("own_mark"), rest.alias("rest"))
    same = F.col("own_id").eqNullSafe(F.col("first_id")) & (F.col("own_mark") == F.col("first_mark"))
    found = rows.join(firsts, same, "left_semi").groupBy("own_id", "own_mark").agg(F.min_by("doc", "rest").alias("doc"))
    return found.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go; texts without one, null and empty ones stay as they are. Repeated rows are copies of
    each other. Every row gives a row."""
    found = substring_dedup.without_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("doc.text"))
    return found.select(*_with_text(docs, "doc", text))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark passages go; texts without one, null and empty ones stay as they are. Every row gives a row."""
    cleaned = decontamination.clean(docs, table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document as little-endian 32-bit integers, and the text that they decode to. A null text is empty.
    Every row gives a row; an empty table gives none."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select(F.struct("doc_id", "lang", "source").alias("doc"), "text")
    found = byte_bpe.round_trip(rows, path, public_tokenizers.PATTERN, id_column="doc")
    n_tokens = (F.octet_length("packed") / 4).cast("bigint").alias("n_tokens")
    return found.select("doc_id.*", n_tokens, "packed", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("benchmark passages", drop_benchmark_passages),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each on what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


ORACLE_SQL = None  # SQL has no fingerprints, language models or tokenizers
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
