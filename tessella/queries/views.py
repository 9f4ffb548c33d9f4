"""Views of the supplied tables that queries share, in Spark and in SQL: the last row of each id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.state import latest
from tessella.tables import table


def artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Artifacts as last delivered, with heading flag and level from their metadata; null content is empty."""
    last = latest(table(spark, d, "artifacts"), "artifact_id", "delivered_at")
    meta = lambda k: F.try_element_at("metadata", F.lit(k))
    return last.select(
        "artifact_id", "document_id", "pos", "artifact_type", F.coalesce("content", F.lit("")).alias("content"), F.coalesce(meta("is_heading") == "true", F.lit(False)).alias("is_heading"),
        meta("heading_level").try_cast("int").alias("heading_level"), meta("status").alias("status"), "source", "confidence", "table_data",
    )


def artifact_sizes(spark: SparkSession, d: str) -> DataFrame:
    """artifacts() with n_chars in place of content, which only headings keep; texts do not reach the shuffle."""
    meta = lambda k: F.try_element_at("metadata", F.lit(k))
    heading = F.coalesce(meta("is_heading") == "true", F.lit(False))
    rows = table(spark, d, "artifacts").select("artifact_id", "delivered_at", "document_id", "pos", heading.alias("is_heading"), meta("heading_level").try_cast("int").alias("heading_level"), F.when(heading, F.coalesce("content", F.lit(""))).alias("content"), F.length(F.coalesce("content", F.lit(""))).alias("n_chars"))
    return latest(rows, "artifact_id", "delivered_at")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "chunks"), "chunk_id", "created_at")


def summaries(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "chunk_summaries"), "summary_id", "summarized_at")


def sections(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "draft_sections"), "section_id", "created_at")


def numeric(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "numeric_entries"), "entry_id", "extracted_at")


def _last(name: str, of: str, key: str, version: str) -> str:
    return f"{name} AS (SELECT * FROM {of} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {version} DESC NULLS LAST) = 1)"


SUMMARIES = _last("su", "chunk_summaries", "summary_id", "summarized_at")
SECTIONS = _last("se", "draft_sections", "section_id", "created_at")
CHUNKS = _last("ch", "chunks", "chunk_id", "created_at")
NUMERIC = _last("nu", "numeric_entries", "entry_id", "extracted_at")
ARTIFACTS = (
    _last("art0", "artifacts", "artifact_id", "delivered_at")
    + """,
art AS (SELECT artifact_id, document_id, pos, artifact_type, coalesce(content, '') AS content, coalesce(metadata['is_heading'] = 'true', false) AS is_heading,
        try_cast(metadata['heading_level'] AS INT) AS heading_level, metadata['status'] AS status, confidence, table_data, source FROM art0)"""
)
#: An id as clean_id() makes it.
CLEAN = "nullif(lower(trim({}, ' ' || chr(9) || chr(13) || chr(10))), '')"
