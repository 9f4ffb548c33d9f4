"""Chunks of sections under a budget of tokens, with an overlap taken from the chunk before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import last_tokens, token_estimate
from tessella.operators.sections import section_paths, with_sections
from tessella.plans.fold import ordered_fold

BUDGET, OVERLAP = 10_000, 500
TABLES, IMAGES = ("table",), ("image", "chart", "map")


def pack(artifacts: DataFrame, budget: int = BUDGET, tokens: Column | None = None, document: str = "document_id", pos: str = "pos") -> DataFrame:
    """Adds n_tokens and chunk_no (from 0 in each section) to artifacts with sections.

    Greedy: an artifact begins a new chunk if it would take the running sum over the budget and the chunk isn't empty.
    One that is larger than the budget stays whole in its own chunk. Sums take no account of overlaps and separators.
    """
    sized = artifacts.withColumn("n_tokens", tokens if tokens is not None else token_estimate(F.col("content")))

    def step(state, row):
        used, no = state or (None, 0)
        n = row["n_tokens"] or 0
        if used is not None and used + n > budget:
            used, no = n, no + 1
        else:
            used = (used or 0) + n
        return (used, no), {"chunk_no": no}

    return ordered_fold(sized, [document, "section_no"], [pos], lambda: None, step, "chunk_no int", ["n_tokens"])


def chunks(artifacts: DataFrame, budget: int = BUDGET, overlap: int = OVERLAP, tokens: Column | None = None) -> DataFrame:
    """Chunks of artifacts (artifact_id, document_id, pos, artifact_type, content, is_heading, heading_level, source).

    Columns document_id, sequence_index, section_no, section_title, chunk_no, heading_path, content, token_count,
    n_artifact_tokens, contains_tables, contains_images, artifact_ids, source_locations. A chunk's path is that after
    the artifact that began the next one, its text is the end of the chunk before in its section, about `overlap`
    tokens, and its artifacts, parted by blank lines; its count includes the overlap.
    """
    packed = section_paths(pack(with_sections(artifacts), budget, tokens))
    inside = Window.partitionBy("document_id", "section_no").orderBy("pos")
    packed = packed.withColumn("path_after", F.when(F.lead("chunk_no").over(inside) != F.col("chunk_no"), F.lead("heading_path").over(inside)).otherwise(F.col("heading_path")))
    member = F.struct("pos", "content", "artifact_id", "source", "path_after")
    grouped = packed.groupBy("document_id", "section_no", "section_title", "chunk_no").agg(
        F.array_sort(F.collect_list(member), lambda a, b: a["pos"] - b["pos"]).alias("m"),
        F.sum("n_tokens").cast("int").alias("n_artifact_tokens"),
        F.bool_or(F.col("artifact_type").isin(*TABLES)).alias("contains_tables"),
        F.bool_or(F.col("artifact_type").isin(*IMAGES)).alias("contains_images"),
    )
    own = F.array_join(F.transform("m", lambda x: F.coalesce(x["content"], F.lit(""))), "\n\n")
    by_section = Window.partitionBy("document_id", "section_no").orderBy("chunk_no")
    by_document = Window.partitionBy("document_id").orderBy("section_no", "chunk_no")
    before = last_tokens(F.lag("own").over(by_section), overlap)
    full = F.concat_ws("\n\n", F.nullif(F.col("before"), F.lit("")), F.col("own"))
    return (
        grouped.withColumn("own", own)
        .withColumn("before", before)
        .withColumn("full", full)
        .select(
            "document_id",
            (F.row_number().over(by_document) - 1).alias("sequence_index"),
            "section_no",
            "section_title",
            "chunk_no",
            F.element_at("m", -1)["path_after"].alias("heading_path"),
            F.btrim("full", F.lit(" \t\r\n")).alias("content"),
            token_estimate(F.col("full")).alias("token_count"),
            "n_artifact_tokens",
            "contains_tables",
            "contains_images",
            F.transform("m", lambda x: x["artifact_id"]).alias("artifact_ids"),
            F.transform("m", lambda x: x["source"]).alias("source_locations"),
        )
    )


def chunk_sizes(artifacts: DataFrame, budget: int = BUDGET, overlap: int = OVERLAP) -> DataFrame:
    """The chunks of chunks() without their texts: document_id, section_no, chunk_no, n_artifact_tokens, token_count.

    `artifacts` has n_chars in place of content, which is only needed of headings; no text is moved.
    """
    sized = with_sections(artifacts).select("document_id", "section_no", "pos", "n_chars", F.greatest(F.lit(1), F.floor(F.col("n_chars") / 4)).cast("int").alias("tokens"))
    packed = pack(sized, budget, F.col("tokens")).groupBy("document_id", "section_no", "chunk_no").agg(F.sum("n_tokens").cast("int").alias("n_artifact_tokens"), (F.sum("n_chars") + 2 * (F.count("*") - 1)).alias("own"))
    by_section = Window.partitionBy("document_id", "section_no").orderBy("chunk_no")
    before = F.least(F.coalesce(F.lag("own").over(by_section), F.lit(0)), F.lit(4 * overlap))
    full = F.col("own") + F.when(before > 0, before + 2).otherwise(0)
    return packed.withColumn("token_count", F.greatest(F.lit(1), F.floor(full / 4)).cast("int")).drop("own")


def chunk_stats(chunked: DataFrame, *by: str) -> DataFrame:
    """Number of chunks and their tokens: sum, whole mean, least and most; by any columns."""
    return chunked.groupBy(*by).agg(
        F.count("*").alias("n_chunks"), F.sum("token_count").alias("sum_tokens"), F.floor(F.sum("token_count") / F.count("*")).alias("avg_tokens"), F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens")
    )
