import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessella.llm import tokens
from tessella.llm.bpe import encoder

P = pytest.importorskip("public_tokenizers")
RAW, PATTERN = tokens.vocabulary()
ENC = encoder(RAW, PATTERN)
REF = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
REF.encode_special_tokens = True
ODD = ["", " ", "\n\n  \t", "<|endoftext|>", "a<|endoftext|>b", "añó ​﻿ 日本語 🌵🌊 👩🏽‍🌾", "don't we'll I'm", "\x00\x01\x7f", "é" * 50, "=" * 500, "a" * 5000, "ab" * 3000, " " * 700 + "x", "  \x85", "１２３ ٣٤ ²³", "x" * 63 + " " + "y" * 65]


def ref(text):
    return REF.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = ENC.encode(text)
    assert ids == ref(text) and ENC.count(text) == len(ids) and ENC.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    ids = ENC.encode(text)
    assert ids == ref(text) and ENC.count(text) == len(ids) and ENC.decode(ids) == text


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab áé日", min_size=1, max_size=1500), st.integers(1, 50))
def test_stream_in_chunks_of_any_size(text, size):
    piece = text.replace(" ", "a").encode()
    seen = []
    got = list(ENC.stream([piece[k : k + size] for k in range(0, len(piece), size)], seen))
    assert got == list(ENC.stream([piece])) and b"".join(ENC.table.tokens[i] for i in got) == piece
    assert all(x < 3 * ENC.table.window for x in seen)


def test_ranks_without_merges_give_the_same():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        other = encoder(f.read(), PATTERN)
    for text in ODD:
        assert other.encode(text) == ENC.encode(text)


def test_ids_of_rows(spark):
    rows = [(1, "hola mundo"), (2, None), (3, ""), (3, ""), (None, "x"), (5, "z" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("key", F.lit(1))
    got = [(r["doc_id"], list(r["ids"])) for r in tokens.token_ids(df, "doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted([(k, ref(t or "")) for k, t in rows], key=str)
    assert tokens.token_ids(df.limit(0), "doc_id", "text").collect() == []


def test_counts_of_rows(spark):
    df = spark.createDataFrame([(1, "hola mundo", 9), (2, None, 9), (3, "", 9)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(df, "text").collect()}
    assert got == {1: len(ref("hola mundo")), 2: 0, 3: 0}


def test_budget_cube(spark):
    docs = spark.createDataFrame([("s1", "es", "a", "uno dos"), ("s1", "ES", None, "tres"), ("s2", None, "a", None), ("s1", "spa", "a", "uno dos")], "source string, lang string, domain string, text string")
    got = {(r["slice"], r["source"], r["lang"], r["domain"]): (r["n_items"], r["n_usable"], r["n_tokens"]) for r in tokens.token_budget(tokens.document_items(docs)).collect()}
    two, three = len(ref("uno dos")), len(ref("tres"))
    assert got["", None, None, None] == (4, 3, 2 * two + three)
    assert got["source+lang+domain", "s1", "es", "a"] == (2, 2, 2 * two)
    assert got["source+lang", "s1", "es", None] == (3, 3, 2 * two + three)
    assert got["lang", None, "und", None] == (1, 0, 0) and got["domain", None, None, "(none)"] == (1, 1, three)
    assert tokens.token_budget(tokens.document_items(docs.limit(0))).filter("n_items > 0").count() == 0


def test_artifacts_count_once(spark):
    a = spark.createDataFrame(
        [("a", "d", 1, "uno", ("IN\\F.docx",)), ("a", "d", 2, "uno dos", ("in/f.docx",)), ("b", "d", None, "tres", (None,)), ("c", "x", 1, "z", (" ",))],
        "artifact_id string, document_id string, t int, content string, source struct<source_file: string>",
    ).withColumn("delivered_at", F.timestamp_seconds("t"))
    p = spark.createDataFrame([("d", "F.docx", None, "k"), ("d", "F.docx", "es-CO", None)], "document_id string, source_file string, lang string, domain string")
    got = set(map(tuple, tokens.artifact_items(a, p).collect()))
    assert got == {("artifacts", None, None, None, 1), ("artifacts", "f.docx", "es", "k", len(ref("tres"))), ("artifacts", "f.docx", "es", "k", len(ref("uno dos")))}


def test_table_of_documents(spark, data):
    from tessella.llm.queries import p6_ids

    rng = random.Random(1)
    rows = p6_ids(spark, data).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rng.sample(rows, min(100, len(rows))):
        assert list(r["ids"]) == ref(texts[r["doc_id"]] or "")
