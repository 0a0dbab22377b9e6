"""Encoding against tiktoken and tokenizers, decoding against the texts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from tidemark.llm import byte_bpe, pretokens, queries, token_counts

RANKS, JSON, PATTERN = (
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.PATTERN,
)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return tokenizers.Tokenizer.from_file(JSON)


def texts():
    draw = random.Random(3)
    fixed = [
        None,
        "",
        "a  b",
        " x",
        "x ",
        "\n\n a\t\tb  ",
        "<|endoftext|>hi<|endoftext|>",
        "a" * 3000,
        "abcde" * 500,
        "À 漢字かな交じり文 😀😀 ''s 't'll",
        "x" * 190 + "é" * 300,
        "   ",
        "ab\x1c cd\u0085 a  b",
        "the" * 300,
        "0123456789" * 30 + " _-__",
        "¡word, word. word?",
    ]
    noise = ["".join(draw.choice("aehtnd oi\n.,1é漢'") for _ in range(draw.randint(1, 300))) for _ in range(80)]
    long = ["".join(draw.choice("aehtndoislrc") for _ in range(draw.randint(201, 900))) for _ in range(4)]
    return [*fixed, *noise, *long, fixed[6]]


def test_encoding_and_decoding_of_odd_texts(odd, reference):
    given = texts()
    docs = odd(given)
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    expected = sorted((r[0] is None, r[0] or 0, reference.encode_ordinary(r[1] or "")) for r in docs.collect())
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in encoded.collect()) == expected
    decoded = sorted(bytes(r["decoded"]) for r in byte_bpe.decode(encoded, RANKS).collect())
    assert decoded == sorted((t or "").encode() for t in given)


@pytest.mark.parametrize("windows", [(48, 192), (16, 48), ()])
def test_long_words_in_windows_are_those_of_the_library(reference, monkeypatch, windows):
    monkeypatch.setattr(byte_bpe, "WINDOWS", windows)
    engine, draw = byte_bpe.Engine(byte_bpe.Ranks(RANKS)), random.Random(8)
    words = ["a" * 1003, "ab" * 300, "aab" * 200, "é" * 301, " " * 600, "the" * 200, "=" * 257 + "-" * 300, "x" * 200 + "y" * 201]
    words += ["".join(draw.choices(letters, k=draw.randint(201, 700))) for letters in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyzäöü") for _ in range(6 if windows else 1)]
    for word in words:
        assert engine.encode([word])[0] == np.array(reference._encode_single_piece(word.encode()), "<i4").tobytes(), word


def test_a_word_of_four_megabytes(reference):
    """In a piece of memory that the word's rows at once would exceed by far."""
    engine = byte_bpe.Engine(byte_bpe.Ranks(RANKS))
    word = "a" * 1_000_003 + "abcdefghij" * 300_000
    assert engine.encode([word])[0] == np.array(reference._encode_single_piece(word.encode()), "<i4").tobytes()


def test_what_is_remembered_is_bounded_by_bytes():
    memory = pretokens.Recent(10_000)
    for i in range(50):
        keys = [f"{i}-{k}" for k in range(10)] + ["long" * 1000 + str(i)]
        assert memory.recall(keys) == keys
        memory.learn(keys, [b"x"] * len(keys))
        assert all(k in memory.new for k in keys)
        memory.age()
        assert sum(pretokens.ENTRY + 2 * len(k) for k in [*memory.new, *memory.old]) < 2 * 10_000 + 5000


def test_round_trip_is_encode_and_decode(odd, reference):
    given = texts()
    rows = byte_bpe.round_trip(odd(given), RANKS, PATTERN).collect()
    assert sorted((bytes(r["packed"]), bytes(r["decoded"])) for r in rows) == sorted(
        (np.array(reference.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for t in given
    )


def test_decoding_null_lists_and_unknown_ids(spark):
    lists = spark.createDataFrame([(1, None), (2, []), (None, [0, 1])], "doc_id bigint, token_ids array<int>")
    assert {r[0]: bytes(r[1]) for r in byte_bpe.decode(lists, RANKS).collect()} == {1: b"", 2: b"", None: b'!"'}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50_256])], lists.schema), RANKS).collect()


def test_the_query_on_all_documents(spark, sf, documents, reference):
    rows = {r["doc_id"]: r for r in queries.op7_byte_bpe(spark, sf).collect()}
    assert len(rows) == len(documents)
    for key, text in documents:
        ids = reference.encode_ordinary(text or "")
        assert rows[key]["n_tokens"] == len(ids)
        assert rows[key]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_counts_of_odd_texts(odd, counter):
    given = texts()
    counted = token_counts.count_tokens(odd(given), JSON, PATTERN).collect()
    expected = [(len((t or "").encode()), len(counter.encode(t or "", add_special_tokens=False).ids)) for t in given]
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in counted) == sorted(expected)


def test_counts_of_all_documents(spark, sf, documents, counter):
    rows = {r["doc_id"]: r for r in queries.op8_token_counts(spark, sf).collect()}
    for key, text in documents:
        n = len(counter.encode(text or "", add_special_tokens=False).ids)
        assert rows[key]["n_tokens"] == n and rows[key]["over_limit"] == (n > 1024)
        assert rows[key]["n_bytes"] == len((text or "").encode())


def test_proved_strings_encode_alone(spark):
    vocabulary = token_counts.Vocabulary(JSON)
    proven = token_counts.prove(spark, vocabulary)
    assert proven <= set(vocabulary.strings) and all(bytes([b]) in proven for b in range(256))
    some = sorted(vocabulary.strings)[::97]
    assert all((len(vocabulary.merge(s)) == 1) == (s in proven) for s in some)


def test_merging_with_a_heap_is_merging_by_scanning():
    vocabulary, draw = token_counts.Vocabulary(JSON), random.Random(1)
    for _ in range(60):
        word = bytes(draw.choice(b" aehtndoi") for _ in range(draw.randint(2, 150)))
        ids = [vocabulary.byte_ids[b] for b in word]
        assert token_counts._scan(list(ids), vocabulary.merges) == token_counts._heap(list(ids), vocabulary.merges)


def test_empty_tables(odd):
    none = odd([])
    assert byte_bpe.encode(none, RANKS, PATTERN).count() == 0
    assert byte_bpe.round_trip(none, RANKS, PATTERN).count() == 0
    assert token_counts.count_tokens(none, JSON, PATTERN).count() == 0
