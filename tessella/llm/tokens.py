"""Token ids of texts, and token budgets of slices (problems 2 and 6)."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.bpe import encoder
from tessella.tables import spread

#: The vocabulary that queries use, of the installed package of public tokenizers.
VOCABULARY = "byte_bpe_50k.json"
#: So many ids are sent back to the JVM at once, so that a batch of very long texts stays small.
SEND_IDS = 1_000_000


def vocabulary(name: str = VOCABULARY) -> tuple[bytes, str]:
    """Content of a public vocabulary file, and the pattern that splits text before its merges.

    The file is read on the driver and broadcast: its size is that of one published vocabulary, under 2 MB, however
    large the texts are. Executors need no such file.
    """
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def token_ids(df: DataFrame, key: str, text: str, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """`key` and `ids`, the token ids of column `text`, one row for each row of `df`.

    Null and empty texts have an empty list. Strings of special tokens are ordinary text; nothing is trimmed or
    normalised. Repeated rows and null keys stay; other columns, whatever their names, are left out. Texts of any
    length are encoded whole: each piece streams through a transducer of bounded lookahead (`Encoder.stream`).
    """
    raw, pattern = vocab or vocabulary()
    shared = df.sparkSession.sparkContext.broadcast(raw)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(shared.value, pattern)
        get, pieces = ids_of.ids_of.__getitem__, ids_of.pieces
        for batch in batches:
            flat, offsets, begin = array("i"), array("i", [0]), 0
            for at, value in enumerate(batch.column(1), 1):
                for piece in pieces(value.as_py() or ""):
                    flat.extend(get(piece))
                offsets.append(len(flat))
                if len(flat) > SEND_IDS or at == batch.num_rows:
                    yield _lists(batch.column(0).slice(begin, at - begin), flat, offsets)
                    flat, offsets, begin = array("i"), array("i", [0]), at

    return spread(df.select(F.col(key).alias(key), F.col(text).alias("text"))).mapInArrow(encode, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def decoded(df: DataFrame, key: str, ids: str, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """`key` and `text`, what token ids stand for, one row for each row of `df`; null and empty lists give an empty text.

    The bytes of a token that ends within a character wait for the next one; what is no UTF-8 becomes the replacement
    character. Ids outside the vocabulary are an error.
    """
    raw, pattern = vocab or vocabulary()
    shared = df.sparkSession.sparkContext.broadcast(raw)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((enc.decode(v.as_py() or ()) for v in batch.column(1)), pa.string())], [key, "text"])

    return df.select(F.col(key).alias(key), F.col(ids).alias("ids")).mapInArrow(decode, f"`{key}` {df.schema[key].dataType.simpleString()}, text string")


def _lists(keys: pa.Array, flat: array, offsets: array) -> pa.RecordBatch:
    ids = pa.ListArray.from_arrays(pa.array(np.frombuffer(offsets, dtype=np.int32)), pa.array(np.frombuffer(flat, dtype=np.int32) if flat else np.empty(0, np.int32)))
    return pa.RecordBatch.from_arrays([keys, ids], ["key", "ids"])


def token_counts(df: DataFrame, text: str, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """`df` without column `text` but with `n_tokens`, the exact number of token ids of it (0 for null and empty texts).

    Counts come from the automaton alone; no ids are made. A column that is called n_tokens already is replaced.
    """
    raw, pattern = vocab or vocabulary()
    shared = df.sparkSession.sparkContext.broadcast(raw)
    kept = [c for c in df.columns if c not in (text, "n_tokens")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        get, pieces = enc.count_of.__getitem__, enc.pieces
        for batch in batches:
            numbers = pa.array((sum(map(get, pieces(v.as_py() or ""))) for v in batch.column(len(kept))), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], numbers], [*kept, "n_tokens"])

    schema = df.select(*(f"`{c}`" for c in kept)).schema.add("n_tokens", "long")
    return spread(df.select(*(f"`{c}`" for c in kept), F.col(text))).mapInArrow(count, schema)


def language(col):
    """A language code in one spelling: two letters in lower case without region; `und` for null and blank."""
    code = F.regexp_extract(F.lower(F.btrim(col)), "^[a-z]+", 0)
    return F.when(code.isin("spa", "esp"), "es").when(code == "eng", "en").when(code == "por", "pt").when(F.coalesce(code, F.lit("")) == "", "und").otherwise(code)


def file_name(col):
    """The bare name of a file, however its path is spelled: no folders, lower case; null for blank."""
    return F.nullif(F.btrim(F.lower(F.element_at(F.split(F.replace(col, F.lit("\\"), F.lit("/")), "/"), -1))), F.lit(""))


def token_budget(items: DataFrame, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """Tokens and items by table, and by every combination of source, language and domain of it.

    `items` has table_name, source, lang, domain and text. Rows: table_name, source, lang, domain (null where the row
    is a total over that column; `slice` says which columns it is not a total over), n_items, n_usable (items with any
    token), n_tokens. Null source, lang and domain count as `(none)`, `und` and `(none)`. An empty table gives no rows.

    Counts shrink to one row a slice before the first shuffle, and the cube runs over slices, so no hot source matters.
    """
    named = items.select(
        "table_name",
        F.coalesce(F.col("source"), F.lit("(none)")).alias("source"),
        language(F.col("lang")).alias("lang"),
        F.coalesce(F.lower(F.btrim("domain")), F.lit("(none)")).alias("domain"),
        F.col("n_tokens") if "n_tokens" in items.columns else F.col("text"),
    )
    counted = named if "n_tokens" in items.columns else token_counts(named, "text", vocab)
    slices = counted.groupBy("table_name", "source", "lang", "domain").agg(F.count("*").alias("n_items"), F.count_if(F.col("n_tokens") > 0).alias("n_usable"), F.sum("n_tokens").alias("n_tokens"))
    sets = [list(x) for x in (("source", "lang", "domain"), ("source", "lang"), ("source", "domain"), ("lang", "domain"), ("source",), ("lang",), ("domain",), ())]
    cube = slices.groupingSets([["table_name", *x] for x in sets], "table_name", "source", "lang", "domain").agg(
        F.grouping("source").alias("no_source"), F.grouping("lang").alias("no_lang"), F.grouping("domain").alias("no_domain"), *(F.sum(c).alias(c) for c in ("n_items", "n_usable", "n_tokens"))
    )
    held = [F.when(F.col(f"no_{c}") == 0, F.lit(c)) for c in ("source", "lang", "domain")]
    return cube.select("table_name", F.concat_ws("+", *held).alias("slice"), "source", "lang", "domain", "n_items", "n_usable", "n_tokens")


def artifact_items(artifacts: DataFrame, parse_results: DataFrame, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """Artifacts as items of token_budget, each once as last delivered, with language and domain of their parse result.

    Tokens are counted before the shuffle that picks the last delivery, so that it moves no text. Of deliveries at the
    same time the one with more tokens counts; null times come first. Of repeated parse results, known values win.
    """
    rows = artifacts.select("artifact_id", "document_id", "delivered_at", file_name(F.col("source.source_file")).alias("file"), F.col("content").alias("text"))
    last = token_counts(rows, "text", vocab).groupBy("artifact_id").agg(F.max(F.struct(F.col("delivered_at"), F.col("n_tokens"), F.col("document_id"), F.col("file"))).alias("x")).select("x.*")
    parsed = parse_results.groupBy("document_id").agg(F.max(F.when(language(F.col("lang")) != "und", language(F.col("lang")))).alias("lang"), F.max("domain").alias("domain"), F.max(file_name(F.col("source_file"))).alias("parsed_file"))
    return last.join(parsed, "document_id", "left").select(F.lit("artifacts").alias("table_name"), F.coalesce("file", "parsed_file").alias("source"), "lang", "domain", "n_tokens")


def document_items(documents: DataFrame, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """Documents as items of token_budget; each row counts."""
    rows = documents.select(F.lit("documents").alias("table_name"), "source", "lang", "domain", "text")
    return token_counts(rows, "text", vocab)


def corpus_budget(spark: SparkSession, artifacts: DataFrame, parse_results: DataFrame, documents: DataFrame, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """Token budget of artifacts and documents together."""
    vocab = vocab or vocabulary()
    return token_budget(artifact_items(artifacts, parse_results, vocab).unionByName(document_items(documents, vocab)), vocab)
