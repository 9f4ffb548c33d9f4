"""The llm queries of the registry, each over whole tables; SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import mixing, residue, splitting, tokens, truncation
from tessella.tables import table


def p2_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return tokens.corpus_budget(spark, table(spark, d, "artifacts"), table(spark, d, "parse_results"), table(spark, d, "documents"))


def p2_items(spark: SparkSession, d: str) -> DataFrame:
    """Of the token budget what SQL can state: items and those with any token, by table and language."""
    return p2_token_budget(spark, d).filter("slice = 'lang'").select("table_name", "lang", "n_items", "n_usable")


def p6_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every document decoded from its ids, as a digest, and whether it has any id."""
    return tokens.decoded(p6_ids(spark, d), "doc_id", "ids").select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n_chars"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(table(spark, d, "documents"), "doc_id", "text")


def _cut(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_records(truncation.summary_records(table(spark, d, "chunk_summaries"), table(spark, d, "draft_sections")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _cut(spark, d).filter("is_cut").select("table_name", "record_id")


def p3_cut_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_rates(_cut(spark, d))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "artifacts"), table(spark, d, "size_limits"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_pieces(spark, d).filter("piece = 1").select("artifact_id")


def p4_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Pieces put together again, overlaps taken off: a digest by artifact, and whether each piece keeps its limit and goes on
    exactly the overlap before the end of the one before it."""
    limits = table(spark, d, "size_limits")
    pieces = p4_pieces(spark, d).join(limits, "artifact_type")
    before = F.lag("end").over(Window.partitionBy("artifact_id").orderBy("piece"))
    fits = (F.length("content") <= F.col("max_chars")) & F.coalesce(before - F.col("begin") == F.col("overlap_chars"), F.col("piece") == 1)
    own = F.when(F.col("piece") == 1, F.col("content")).otherwise(F.expr("substring(content, overlap_chars + 1)"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("piece", own.alias("own")))), lambda x: x["own"])
    return pieces.withColumn("fits", fits).groupBy("artifact_id").agg(F.md5(F.array_join(parts, "")).alias("digest"), F.bool_and("fits").alias("fits"))


def p7_limits(spark: SparkSession, d: str) -> DataFrame:
    """Whether each source of each plan keeps its cap and its documents, and whether the shares of the plan add up to 1."""
    shares = p7_shares(spark, d)
    capped = F.coalesce(F.col("most_uses") <= F.col("max_repeats"), F.lit(True)) & (F.col("n_docs") <= F.col("n_uses"))
    whole = F.sum("reached_share").over(Window.partitionBy("plan_name"))
    return shares.select("plan_name", "source", capped.alias("is_capped"), ((F.abs(whole - 1) < 1e-9) | (whole == 0)).alias("adds_up"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(mixing.counted_documents(table(spark, d, "documents")), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    counted, targets = mixing.counted_documents(table(spark, d, "documents")), table(spark, d, "mix_targets")
    return mixing.reached_shares(mixing.mix(counted, targets), counted, targets)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents"), "doc_id", "text").filter("is_residue").select("doc_id").distinct()


def p8_clean_corpus(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p2_token_budget, p2_items, p3_found, p3_cut_rates, p4_found, p4_pieces, p4_rejoined, p6_ids, p6_roundtrip, p7_mix, p7_shares, p7_limits, p8_found, p8_clean_corpus)}
_LANGUAGE = "CASE WHEN regexp_extract(lower(trim(lang, ' ')), '^[a-z]+') IN ('spa', 'esp') THEN 'es' WHEN regexp_extract(lower(trim(lang, ' ')), '^[a-z]+') = 'eng' THEN 'en' WHEN regexp_extract(lower(trim(lang, ' ')), '^[a-z]+') = 'por' THEN 'pt' WHEN coalesce(regexp_extract(lower(trim(lang, ' ')), '^[a-z]+'), '') = '' THEN 'und' ELSE regexp_extract(lower(trim(lang, ' ')), '^[a-z]+') END"
_LAST = "SELECT artifact_id, document_id, content, artifact_type FROM artifacts QUALIFY row_number() OVER (PARTITION BY artifact_id ORDER BY delivered_at DESC NULLS LAST) = 1"
SQL: dict[str, str] = {
    "p2_items": f"""
WITH p AS (SELECT document_id, max(nullif({_LANGUAGE}, 'und')) AS lang FROM parse_results GROUP BY 1)
SELECT 'documents' AS table_name, {_LANGUAGE} AS lang, count(*) AS n_items, count(*) FILTER (length(text) > 0) AS n_usable FROM documents GROUP BY 2
UNION ALL SELECT 'artifacts', coalesce(p.lang, 'und'), count(*), count(*) FILTER (length(content) > 0) FROM ({_LAST}) LEFT JOIN p USING (document_id) GROUP BY 2
""",
    "p4_rejoined": f"SELECT artifact_id, md5(content) AS digest, true AS fits FROM ({_LAST}) JOIN size_limits USING (artifact_type) WHERE length(content) > max_chars",
    "p6_roundtrip": "SELECT doc_id, md5(coalesce(text, '')) AS digest, length(coalesce(text, '')) AS n_chars FROM documents",
    "p7_limits": "SELECT DISTINCT plan_name, source, true AS is_capped, true AS adds_up FROM mix_targets",
    "p4_found": """
SELECT artifact_id FROM (
  SELECT artifact_id, arg_max(struct_pack(x := length(content)), struct_pack(d := delivered_at, n := coalesce(length(content), 0))).x AS n,
         arg_max(artifact_type, struct_pack(d := delivered_at, n := coalesce(length(content), 0))) AS artifact_type
  FROM artifacts GROUP BY artifact_id) JOIN size_limits USING (artifact_type) WHERE n > max_chars
""",
}
