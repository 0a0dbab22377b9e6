"""The registered query of every operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe, chat, conversation_repair, decontamination, hard_negatives, language_model, languages, license_scan, pivot_search, quality, simhash, substring_dedup, token_counts,
)
from tidemark.llm.common import held_out, sha256, table

TOKEN_LIMIT = 1024
GOOD = 0.3


def op1_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors of highest integer inner product for every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings").where(pivot_search.usable("embedding"))
    rows = rows.select("vec_id", pivot_search.scaled("embedding", 1024).alias("vector"))
    return pivot_search.nearest(rows, F.col("vec_id") % 100 == 0, k=10)


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of every document under the counts of all."""
    scores = language_model.log_scores(table(spark, sf_dir, "documents"))
    per_word = F.round(F.try_divide("log_score", "n_words"), 4).alias("per_word")
    return scores.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), per_word)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every document, learned from those whose key is not held out."""
    documents = table(spark, sf_dir, "documents")
    apart = held_out("doc_id", 4, 2)
    model = languages.fit(documents.where(languages.learnable(apart)))
    return languages.predict(documents, model).select("doc_id", apart.alias("held_out"), "lang_pred", "score", "languages")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that also stand elsewhere, as a digest."""
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and one that is full of control strings; digests are read back."""
    planted = [(-7, i, role, r"\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(planted, "conv_id bigint, turn bigint, role string, text string"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                read, loss = chat.read_back(text), chat.loss_text(text, turns)
                whole = "".join(f"{role}\n{said}\n" for role, said in read)
                found.append((len(read), sha256(whole.encode()), len(loss), sha256(loss.encode()), len(text)))
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, batch.column(3)], names)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]
    return chat.format_conversations(rows).mapInArrow(
        digests,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, rewrites_history boolean",
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests of both."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, cache=200 << 20)
    return found.select(
        "doc_id",
        (F.octet_length("packed") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens exceed the limit."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.withColumn("fingerprint", simhash.hexadecimal("fingerprint"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels whose key is not held out."""
    documents, apart = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    model = quality.fit(documents, table(spark, sf_dir, "labels"), ~apart)
    scored = quality.score(documents, model)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each of the five nearest rows of its label of every hundredth vector; every seventh label is moved."""
    rows = table(spark, sf_dir, "embeddings").where(pivot_search.usable("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    rows = rows.select("vec_id", label, pivot_search.scaled("embedding", 256).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements of every document: places of the base phrases, and the labels that all rules leave."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    base, kept = F.filter("found", lambda d: d["base"]), F.filter("found", lambda d: d["kept"])

    def labels(detections: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")

    return found.select(
        "doc.doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.filter("found", lambda d: d["base"] | d["kept"])).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged and repaired; one that loses all its rows has zeros."""
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), nothing)


QUERIES = {"op12_license_scan": op12_license_scan, "op11_hard_negatives": op11_hard_negatives, "op13_conversation_repair": op13_conversation_repair, "op10_quality": op10_quality, "op1_pivot_search": op1_pivot_search, "op2_language_model": op2_language_model, "op3_decontamination": op3_decontamination, "op4_language": op4_language, "op5_substring_dedup": op5_substring_dedup, "op6_chat": op6_chat, "op9_simhash": op9_simhash, "op7_byte_bpe": op7_byte_bpe, "op8_token_counts": op8_token_counts}
_CAPITALS = ", ".join(repr(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
# Operators that SQL can express. Languages, quality, tokenizers, hashes that the engine lacks and digests of
# windows are tested against brute force instead.
ORACLE = {
    "op1_pivot_search": """
      WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_hard_negatives": """
      WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
      s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
      p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
      n AS (SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
          row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
      SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op2_language_model": f"""
      WITH cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^ \\x09-\\x0D]+') AS ws FROM documents),
      words AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS u FROM cut, unnest(range(1, len(ws) + 1)) t(i)),
      c1 AS (SELECT w, count(*) AS n FROM words GROUP BY w),
      c2 AS (SELECT u, w, count(*) AS n FROM words WHERE u IS NOT NULL GROUP BY u, w),
      scored AS (SELECT doc_id, CASE WHEN c2.n IS NOT NULL THEN ln(c2.n / cu.n)
          ELSE ln(CASE WHEN words.u IS NULL THEN 1e0 ELSE 0.4e0 END * cw.n / (SELECT count(*) FROM words)) END AS s
        FROM words JOIN c1 cw ON cw.w = words.w LEFT JOIN c1 cu ON cu.w = words.u
        LEFT JOIN c2 ON c2.u = words.u AND c2.w = words.w),
      sums AS (SELECT doc_id, count(*) AS n, sum(s) AS s FROM scored GROUP BY doc_id)
      SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(s, 0e0), 3) AS log_score, round(s / n, 4) AS per_word
      FROM documents LEFT JOIN sums USING (doc_id)""",
    "op3_decontamination": f"""
      WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {_CAPITALS}), {_WORD}) AS ws
        FROM benchmark WHERE item_id IS NOT NULL),
      phrases AS (SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i:i + 9], ' ') AS phrase
        FROM items, unnest(range(1, greatest(1, len(ws) - 9) + 1)) t(i) WHERE len(ws) > 0),
      cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), {_WORD}) AS ws FROM documents),
      found AS (SELECT doc_id, i, windows.n, item FROM (
          SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase
          FROM cut, (SELECT DISTINCT n FROM phrases) sizes, unnest(range(1, len(ws) - n + 2)) t(i)) windows JOIN phrases USING (n, phrase)),
      hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) t(j) GROUP BY doc_id),
      named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
      SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM cut LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op5_substring_dedup": """
      WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS ws FROM documents),
      words AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i + 34 <= len(ws) THEN array_to_string(ws[i:i + 34], ' ') END AS win
        FROM cut, unnest(range(1, len(ws) + 1)) t(i)),
      flags AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM words),
      marked AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM flags)
      SELECT doc_id, count(w) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        sha256(coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
      FROM documents LEFT JOIN marked USING (doc_id) GROUP BY doc_id""",
    "op6_chat": """
      WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
      shown AS (SELECT *, CASE WHEN regexp_full_match(role, '[a-z]+') THEN role ELSE '\\' || role END AS name FROM turns),
      sized AS (SELECT *, length(replace(replace(replace(replace(name, '\\', '\\b'), '###', '\\h'), '</turn>', '\\e'), ':', '\\c'))
          + length(replace(replace(replace(text, '\\', '\\b'), '###', '\\h'), '</turn>', '\\e')) + length('### ' || ': ' || ' </turn>') + 1 AS n
        FROM shown)
      SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(n) AS BIGINT) AS formatted_chars, false AS rewrites_history
      FROM sized GROUP BY conv_id""",
}
