"""Queries of the general problems of the training-data pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import orphans, units
from tessella.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return units.same_amount_pairs(table(spark, d, "numeric_entries"), table(spark, d, "indicators"))


def p1_amounts(spark: SparkSession, d: str) -> DataFrame:
    return units.amounts(table(spark, d, "numeric_entries"), table(spark, d, "indicators"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(
        table(spark, d, "chunks"),
        "chunk_id",
        "created_at",
        "deleted_at",
        orphans.references(table(spark, d, "draft_sections"), "draft_sections", "section_id", "source_chunk_ids", "created_at"),
        orphans.references(table(spark, d, "provenance_records"), "provenance_records", "record_id", "chunk_ids", "recorded_at"),
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "record_id", F.col("key").alias("chunk_id")).distinct()


def p5_orphans_by_month(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphans_by_period(_orphans(spark, d))


QUERIES = {"p1_found": p1_found, "p1_amounts": p1_amounts, "p5_found": p5_found, "p5_orphans_by_month": p5_orphans_by_month}

_REFERENCES = """
WITH refs AS (
  SELECT DISTINCT table_name, record_id, lower(trim(item, ' ' || chr(9) || chr(10) || chr(13))) AS key, t FROM (
    SELECT 'draft_sections' AS table_name, section_id AS record_id, unnest(source_chunk_ids) AS item, created_at AS t FROM draft_sections
    UNION ALL
    SELECT 'provenance_records', record_id, unnest(chunk_ids), recorded_at FROM provenance_records)
  WHERE trim(item, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
orphans AS (
  SELECT * FROM refs r WHERE NOT EXISTS (
    SELECT 1 FROM chunks c WHERE lower(trim(c.chunk_id, ' ' || chr(9) || chr(10) || chr(13))) = r.key
      AND c.created_at <= r.t AND (c.deleted_at IS NULL OR r.t < c.deleted_at)))
"""

SQL = {
    "p5_found": _REFERENCES + "SELECT DISTINCT table_name, record_id, key AS chunk_id FROM orphans",
    "p5_orphans_by_month": _REFERENCES + "SELECT table_name, strftime(t, '%Y-%m') AS month, count(*) AS n_references, count(DISTINCT record_id) AS n_records FROM orphans GROUP BY 1, 2",
}
