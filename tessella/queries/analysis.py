"""Queries on lineage, gates, retrieval, synthesis, usage, state and relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.operators import enrich, lineage, quality, relational, retrieval, state, synthesis, usage
from tessella.queries import views as V
from tessella.tables import table

REFERENCES = f"""refs AS (SELECT section_id, n AS ref_no, {V.CLEAN.format("item")} AS chunk_id FROM
  (SELECT section_id, unnest(source_chunk_ids) AS item, generate_subscripts(source_chunk_ids, 1) - 1 AS n FROM se) WHERE {V.CLEAN.format("item")} IS NOT NULL)"""
LAST_SUMMARY = f"""ls AS (SELECT {V.CLEAN.format("chunk_id")} AS chunk_id, summary_id, provenance_id, source_file FROM su WHERE chunk_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {V.CLEAN.format("chunk_id")} ORDER BY summarized_at DESC NULLS LAST, summary_id DESC) = 1)"""
QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Registers a query by its name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(col, name: str):
    return F.round(col, 6).alias(name)


# Lineage


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {REFERENCES}, {LAST_SUMMARY}
SELECT section_id, CAST(ref_no AS INT) AS ref_no, r.chunk_id, CASE WHEN summary_id IS NULL THEN 'missing:' || r.chunk_id ELSE provenance_id END AS provenance_id, source_file, summary_id IS NOT NULL AS is_known
FROM refs r LEFT JOIN ls ON r.chunk_id = ls.chunk_id""")
def lineage_chain(spark: SparkSession, d: str) -> DataFrame:
    return lineage.lineage_chain(V.sections(spark, d), V.summaries(spark, d))


@query(f"""WITH {V.SECTIONS}, {REFERENCES}, f AS (SELECT {V.CLEAN.format("chunk_id")} AS chunk_id, max(source_file) AS source_file, max(coalesce(len(source_locations), 0)) AS n FROM chunks GROUP BY 1),
g AS (SELECT section_id, list_sort(list(DISTINCT source_file) FILTER (source_file IS NOT NULL)) AS files, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM refs LEFT JOIN f USING (chunk_id) GROUP BY 1)
SELECT se.section_id, coalesce(array_to_string(files, ','), '') AS source_files, coalesce(n, 0) AS n_locations FROM se LEFT JOIN g USING (section_id)""")
def section_sources(spark: SparkSession, d: str) -> DataFrame:
    return lineage.section_sources(V.sections(spark, d), table(spark, d, "chunks")).select("section_id", F.array_join("source_files", ",").alias("source_files"), "n_locations")


@query(f"WITH {V.SUMMARIES}, {V.SECTIONS}, {REFERENCES}, {LAST_SUMMARY} SELECT section_id, CAST(ref_no AS INT) AS ref_no, chunk_id FROM refs WHERE chunk_id NOT IN (SELECT chunk_id FROM ls)")
def unknown_references(spark: SparkSession, d: str) -> DataFrame:
    return lineage.unknown_references(V.sections(spark, d), V.summaries(spark, d)).select("section_id", "ref_no", "chunk_id")


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {REFERENCES}, {LAST_SUMMARY}, w AS (SELECT count(DISTINCT section_id) AS n_with FROM refs), t AS (SELECT count(*) AS n_sections FROM se), u AS (SELECT count(*) AS n_unknown FROM refs WHERE chunk_id NOT IN (SELECT chunk_id FROM ls))
SELECT n_sections, n_with, n_sections - n_with AS n_without, n_unknown, round(n_with / n_sections, 6) AS coverage, n_sections = n_with AS is_valid FROM w, t, u""")
def reference_report(spark: SparkSession, d: str) -> DataFrame:
    return lineage.reference_report(V.sections(spark, d), V.summaries(spark, d)).withColumn("coverage", F.round("coverage", 6))


@query(f"WITH {V.SECTIONS}, {REFERENCES} SELECT chunk_id, count(*) AS n_references, count(DISTINCT section_id) AS n_sections, min(section_id) AS first_section FROM refs GROUP BY 1")
def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    return lineage.inverted_index(V.sections(spark, d))


@query(f"""WITH {V.SUMMARIES}, {V.NUMERIC}, n AS (SELECT source_file, count(*) AS n_numeric FROM nu GROUP BY 1)
SELECT source_file, count(*) AS n_chunks, round(avg(CAST(confidence AS DECIMAL(18,9))), 6) AS avg_confidence, CAST(sum(coalesce(len(key_facts), 0)) AS BIGINT) AS n_facts, CAST(sum(coalesce(len(uncertainties), 0)) AS BIGINT) AS n_uncertainties, coalesce(max(n_numeric), 0) AS n_numeric
FROM su LEFT JOIN n USING (source_file) GROUP BY 1""")
def file_stats(spark: SparkSession, d: str) -> DataFrame:
    return lineage.file_stats(V.summaries(spark, d), V.numeric(spark, d)).withColumn("avg_confidence", F.round("avg_confidence", 6))


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {REFERENCES}, {LAST_SUMMARY}, c AS (SELECT section_id, count(*) AS n, count(*) FILTER (summary_id IS NULL) AS u, array_to_string(list_sort(list(DISTINCT source_file) FILTER (source_file IS NOT NULL)), ', ') AS files FROM refs LEFT JOIN ls USING (chunk_id) GROUP BY 1)
SELECT section_id, '- **' || coalesce(heading, '') || '**: ' || coalesce(n, 0) || ' references, ' || coalesce(u, 0) || ' unknown, files: ' || coalesce(nullif(files, ''), 'none') AS line FROM se LEFT JOIN c USING (section_id)""")
def section_report(spark: SparkSession, d: str) -> DataFrame:
    se = V.sections(spark, d)
    return lineage.section_report(se, lineage.lineage_chain(se, V.summaries(spark, d)))


# Gates


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    c = F.coalesce("confidence", F.lit(0.0))
    return V.sections(spark, d).select("section_id", "draft_id", "confidence", F.when(c < 0.6, "reject").when(c < 0.75, "edit").otherwise("accept").alias("verdict"), F.when(c < 0.55, "high").otherwise("low").alias("risk_level"))


ANNOTATIONS = "an AS (SELECT section_id, draft_id, confidence, CASE WHEN coalesce(confidence, 0) < 0.6 THEN 'reject' WHEN coalesce(confidence, 0) < 0.75 THEN 'edit' ELSE 'accept' END AS verdict, CASE WHEN coalesce(confidence, 0) < 0.55 THEN 'high' ELSE 'low' END AS risk_level FROM se)"
_CONFIDENCE = "SELECT '{name}' AS gate_name, count(*) FILTER (coalesce(confidence, 0) < 0.85) = 0 AS passed, round(coalesce(avg(CAST(coalesce(confidence, 0) AS DECIMAL(18,9))), 1), 6) AS score, count(*) AS items_checked, count(*) FILTER (coalesce(confidence, 0) >= 0.85) AS items_passed, count(*) FILTER (coalesce(confidence, 0) < 0.85) AS items_failed FROM {of}"
GATES = {
    "gate_summary": f"WITH {V.SUMMARIES} " + _CONFIDENCE.format(name="summary_confidence", of="su"),
    "gate_draft": f"WITH {V.SECTIONS} " + _CONFIDENCE.format(name="draft_confidence", of="se"),
    "gate_completeness": f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {REFERENCES}, ex AS (SELECT DISTINCT h.text AS heading FROM (SELECT unnest(heading_structure) AS h FROM parse_results) WHERE h.level = 1),
  kn AS (SELECT DISTINCT {V.CLEAN.format("chunk_id")} AS chunk_id FROM su WHERE chunk_id IS NOT NULL), ud AS (SELECT DISTINCT chunk_id FROM refs),
  c AS (SELECT (SELECT count(*) FROM ex) AS wanted, (SELECT count(*) FROM ex WHERE heading NOT IN (SELECT heading FROM se WHERE heading IS NOT NULL)) AS missing, (SELECT count(*) FROM ud) AS used, (SELECT count(*) FROM kn) AS known, (SELECT count(*) FROM kn WHERE chunk_id NOT IN (SELECT chunk_id FROM ud)) AS unused)
  SELECT 'completeness' AS gate_name, missing = 0 AND used / known >= 0.5 AS passed, round(used / known, 6) AS score, wanted + known AS items_checked, wanted - missing + used AS items_passed, missing + unused AS items_failed FROM c""",
    "gate_review": f"WITH {V.SECTIONS}, {ANNOTATIONS} SELECT 'review_quality' AS gate_name, count(*) FILTER (verdict = 'reject') <= 0.15 * count(*) AND avg(CAST(confidence AS DECIMAL(18,9))) >= 0.7 AND count(*) FILTER (risk_level = 'high') = 0 AS passed, round(avg(CAST(confidence AS DECIMAL(18,9))), 6) AS score, count(*) AS items_checked, count(*) FILTER (verdict = 'accept') AS items_passed, count(*) FILTER (verdict = 'reject') AS items_failed FROM an",
    "gate_slides": f"WITH {V.SUMMARIES} SELECT 'slide_quality' AS gate_name, false AS passed, CAST(0.5 AS DOUBLE) AS score, count(*) AS items_checked, count(*) FILTER (coalesce(len(key_facts), 0) <= 2) AS items_passed, count(*) FILTER (len(key_facts) > 2) + CASE WHEN count(*) BETWEEN 80 AND 100 THEN 0 ELSE 1 END AS items_failed FROM su",
}


def _rounded(gate: DataFrame) -> DataFrame:
    return gate.withColumn("score", F.round("score", 6))


@query(GATES["gate_summary"])
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(quality.confidence_gate(V.summaries(spark, d), "summary_confidence"))


@query(GATES["gate_draft"])
def gate_draft(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(quality.confidence_gate(V.sections(spark, d), "draft_confidence"))


@query(GATES["gate_completeness"])
def gate_completeness(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "parse_results").select(F.explode("heading_structure").alias("h")).filter("h.level = 1").select(F.col("h.text").alias("heading"))
    return _rounded(quality.completeness_gate(V.sections(spark, d), expected, V.summaries(spark, d)))


@query(GATES["gate_review"])
def gate_review(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(quality.review_gate(_annotations(spark, d), T.exact_mean(F.col("confidence")), F.count_if(F.col("risk_level") == "high")))


@query(GATES["gate_slides"])
def gate_slides(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(quality.slide_gate(V.summaries(spark, d).select(F.col("key_facts").alias("bullets")), bullets=2))


@query()
def gate_numeric(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(quality.numeric_gate(V.numeric(spark, d).filter("value is not null"), V.sections(spark, d)))


@query(" UNION ALL ".join(f"SELECT * FROM ({GATES[k]})" for k in ("gate_summary", "gate_draft", "gate_completeness", "gate_review")))
def all_gates(spark: SparkSession, d: str) -> DataFrame:
    return quality.all_gates(gate_summary(spark, d), gate_draft(spark, d), gate_completeness(spark, d), gate_review(spark, d))


@query(" UNION ALL ".join(f"SELECT gate_name, '## ' || gate_name || ': ' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || chr(10) || '- Score: ' || printf('%.2f', score) || chr(10) || '- Items: ' || items_passed || '/' || items_checked || ' passed' AS text FROM ({GATES[k]})" for k in ("gate_summary", "gate_draft", "gate_completeness", "gate_review")))
def gate_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.gate_report(all_gates(spark, d))


@query()
def numeric_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Numeric entries that no number in the text of the draft comes near, by unit and severity."""
    missing = quality.unmatched_numbers(V.numeric(spark, d).filter("value is not null"), V.sections(spark, d))
    return missing.groupBy("unit", "severity").agg(F.count("*").alias("n_missing"))


@query(f"""WITH {V.NUMERIC}, {V.SUMMARIES}, f AS (SELECT DISTINCT x.numeric_value AS v FROM (SELECT unnest(key_facts) AS x FROM su) WHERE x.numeric_value IS NOT NULL)
SELECT entry_id FROM nu WHERE value IS NOT NULL AND EXISTS (SELECT 1 FROM f WHERE (nu.value = 0 AND f.v = 0) OR (nu.value <> 0 AND abs(f.v - nu.value) <= 0.05 * abs(nu.value)))""")
def numeric_band(spark: SparkSession, d: str) -> DataFrame:
    facts = V.summaries(spark, d).select(F.explode("key_facts").alias("x")).select(F.col("x.numeric_value").alias("value")).distinct()
    return quality.band_semi(V.numeric(spark, d).filter("value is not null"), facts).select("entry_id")


@query(f"WITH {V.SECTIONS}, {ANNOTATIONS} SELECT draft_id, count(*) FILTER (verdict = 'accept') AS n_accept, count(*) FILTER (verdict = 'edit') AS n_edit, count(*) FILTER (verdict = 'reject') AS n_reject FROM an GROUP BY 1")
def verdict_pivot(spark: SparkSession, d: str) -> DataFrame:
    return quality.verdict_counts(_annotations(spark, d), "draft_id")


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {ANNOTATIONS}
SELECT 'low_confidence_summary' AS kind, summary_id AS item_id, 'confidence ' || printf('%.3f', coalesce(confidence, 0)) AS reason FROM su WHERE coalesce(confidence, 0) < 0.7
UNION ALL SELECT 'high_risk_annotation', section_id, verdict || ' ' || risk_level FROM an WHERE verdict = 'reject' OR risk_level = 'high'""")
def human_queue(spark: SparkSession, d: str) -> DataFrame:
    return quality.review_queue(V.summaries(spark, d), _annotations(spark, d), 0.7)


# Retrieval

_NEAR = """WITH q AS (SELECT vec_id AS query_id, embedding AS qe, label AS ql FROM embeddings WHERE vec_id % 100 = 0),
d AS (SELECT query_id, vec_id, list_sum(list_transform(list_zip(qe, embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS distance FROM q, embeddings e {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5"""


def _queries_of(vectors: DataFrame) -> DataFrame:
    return vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query(_NEAR.format(where=""))
def knn_l2(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return retrieval.nearest(v, _queries_of(v), 5).withColumn("distance", F.round("distance", 6))


@query(_NEAR.format(where="WHERE e.label < 5"))
def knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return retrieval.nearest(v, _queries_of(v), 5, where=F.col("label") < 5).withColumn("distance", F.round("distance", 6))


@query()
def embed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Stand-in vectors of chunks: their length and first cell."""
    e = retrieval.embed(V.chunks(spark, d), "chunk_id", "content")
    return e.select("chunk_id", F.size("embedding").alias("n"), F.round(F.get("embedding", 0), 6).alias("first"))


@query("SELECT chunk_id, document_id, sequence_index FROM (SELECT DISTINCT chunk_id, document_id, sequence_index FROM chunks WHERE contains_tables) ORDER BY document_id, sequence_index, chunk_id LIMIT 100")
def metadata_top(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select("chunk_id", "document_id", "sequence_index", "contains_tables").distinct()
    return retrieval.by_metadata(rows, F.col("contains_tables"), 100, "document_id", "sequence_index", "chunk_id").drop("contains_tables")


@query(f"WITH {V.ARTIFACTS} SELECT artifact_id, document_id, pos, artifact_type, length(content) AS n_chars FROM art")
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    return V.artifacts(spark, d).select("artifact_id", "document_id", "pos", "artifact_type", F.length("content").cast("long").alias("n_chars"))


# Synthesis

_KEY = "coalesce(nullif(section_title, ''), nullif(heading_path[1], ''), 'General')"
_GROUPS = f"gr AS (SELECT {_KEY} AS section, row_number() OVER (ORDER BY {_KEY}) AS ord FROM su GROUP BY 1)"


@query(f"WITH {V.SUMMARIES} SELECT {_KEY} AS section, count(*) AS n_summaries, round(coalesce(avg(CAST(confidence AS DECIMAL(18,9))), 0), 6) AS avg_confidence, string_agg(summary_id, ',' ORDER BY sequence_index NULLS FIRST, document_id, summary_id) AS summary_ids FROM su GROUP BY 1")
def section_groups(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.section_groups(V.summaries(spark, d)).select("section", "n_summaries", r6(F.col("avg_confidence"), "avg_confidence"), F.array_join("summary_ids", ",").alias("summary_ids"))


def _named_groups(spark: SparkSession, d: str) -> DataFrame:
    """Section keys with their place in order of name, by range partitions and not in one task."""
    names = V.summaries(spark, d).select(synthesis.section_key(F.col("section_title"), F.col("heading_path")).alias("section")).distinct()
    return names.select("section", F.col("section").alias("ord"))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    """Headings of the draft, and their last three words as looser targets."""
    words = F.split("heading", " ")
    h = V.sections(spark, d).filter("heading is not null")
    return h.select(F.col("heading").alias("target")).union(h.select(F.array_join(F.slice(words, F.greatest(F.size(words) - 2, F.lit(1)), F.lit(3)), " "))).distinct()


_TARGETS = "tg AS (SELECT heading AS target FROM se WHERE heading IS NOT NULL UNION SELECT array_to_string(string_split(heading, ' ')[greatest(len(string_split(heading, ' ')) - 2, 1):greatest(len(string_split(heading, ' ')) - 2, 1) + 2], ' ') FROM se WHERE heading IS NOT NULL)"
_LOOSE = "lo AS (SELECT target, arg_min(section, ord) AS section FROM tg, gr WHERE target <> '' AND section <> '' AND (contains(lower(target), lower(section)) OR contains(lower(section), lower(target))) GROUP BY 1)"


@query(f"WITH {V.SUMMARIES}, {V.SECTIONS}, {_GROUPS}, {_TARGETS}, {_LOOSE} SELECT target, section FROM lo")
def fuzzy_sections(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.contains_match(_targets(spark, d), _named_groups(spark, d))


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, {_GROUPS}, {_TARGETS}, {_LOOSE}
SELECT tg.target, coalesce(gr.section, lo.section) AS section, CASE WHEN gr.section IS NOT NULL THEN 'exact' WHEN lo.section IS NOT NULL THEN 'contains' ELSE 'none' END AS how FROM tg LEFT JOIN gr ON gr.section = tg.target LEFT JOIN lo ON lo.target = tg.target""")
def section_cascade(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.match_sections(_targets(spark, d), _named_groups(spark, d))


@query(f"WITH {V.SUMMARIES}, {V.SECTIONS} SELECT summary_id FROM su WHERE lower(trim(summary_id, ' ')) NOT IN (SELECT {V.CLEAN.format('x')} FROM (SELECT unnest(source_summary_ids) AS x FROM se) WHERE {V.CLEAN.format('x')} IS NOT NULL)")
def appendix_unused(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.unused_summaries(V.summaries(spark, d), V.sections(spark, d)).select("summary_id")


@query(f"""WITH {V.SUMMARIES}, {V.SECTIONS}, l AS (SELECT heading, arg_max(section_id, (pos, section_id)) AS found FROM se GROUP BY 1), n AS (SELECT DISTINCT {_KEY} AS name FROM su)
SELECT name, coalesce(found, name) AS section_id FROM n LEFT JOIN l ON l.heading = n.name""")
def heading_to_id(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.heading_ids(_named_groups(spark, d).select(F.col("section").alias("name")), V.sections(spark, d))


@query(f"""WITH {V.SECTIONS}, o AS (SELECT heading, arg_max(struct_pack(x := confidence), (pos, section_id)).x AS c FROM se WHERE version = 1 GROUP BY 1)
SELECT section_id, round(coalesce(c, 0), 6) AS carried FROM se LEFT JOIN o ON o.heading = se.heading WHERE version = 2""")
def carried_lineage(spark: SparkSession, d: str) -> DataFrame:
    se = V.sections(spark, d)
    return synthesis.carried_lineage(se.filter("version = 2").select("section_id", "heading"), se.filter("version = 1")).select("section_id", r6(F.col("confidence"), "carried"))


_ALLOCATED = f"""WITH {V.SECTIONS}, w AS (SELECT draft_id, section_id, heading, pos, len(regexp_extract_all(coalesce(content, ''), '[^\\t-\\r \\x{{85}}\\p{{Z}}]+')) AS n_words FROM se),
f AS (SELECT *, sum(n_words) OVER (PARTITION BY draft_id) AS all_words, count(*) OVER (PARTITION BY draft_id) AS n FROM w),
g AS (SELECT *, CASE WHEN all_words > 0 THEN greatest(1, round_even(n_words / all_words * 98, 0)) END AS first FROM f),
t AS (SELECT *, sum(first) OVER (PARTITION BY draft_id) AS total FROM g),
al AS (SELECT *, CAST(CASE WHEN all_words > 0 THEN greatest(1, round_even(first * CASE WHEN total > 98 THEN 98.0::DOUBLE / total WHEN total < 78 THEN 78.0::DOUBLE / greatest(total, 1) ELSE 1 END, 0)) ELSE floor(98 / n) END AS INT) AS n_slides FROM t)"""


@query(f"{_ALLOCATED} SELECT draft_id, section_id, CAST(n_words AS INT) AS n_words, n_slides FROM al")
def slide_alloc(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.allocate(V.sections(spark, d)).select("draft_id", "section_id", "n_words", "n_slides")


@query(f"""{_ALLOCATED}, x AS (SELECT draft_id, -2 AS pos, 'title' AS heading, '' AS section_id, 1 AS n FROM (SELECT DISTINCT draft_id FROM al) UNION ALL SELECT draft_id, -1, 'contents', '', 1 FROM (SELECT DISTINCT draft_id FROM al)
UNION ALL SELECT draft_id, pos, heading, section_id, unnest(generate_series(1, greatest(n_slides, 1))) FROM al)
SELECT draft_id, CAST(row_number() OVER (PARTITION BY draft_id ORDER BY pos, section_id, n) AS INT) AS slide_number, section_id, heading, CAST(n AS INT) AS n FROM x""")
def slide_numbers(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.numbered_slides(synthesis.allocate(V.sections(spark, d)))


@query(f"WITH {V.SUMMARIES} SELECT summary_id, CAST(n AS INT) AS fact_no, f.category AS category, f.fact AS fact FROM (SELECT summary_id, unnest(key_facts[1:3]) AS f, generate_subscripts(key_facts[1:3], 1) - 1 AS n FROM su)")
def top_facts(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.first_facts(V.summaries(spark, d), 3, None).select("summary_id", "fact_no", "category", "fact")


@query(f"WITH {V.SUMMARIES} SELECT summary_id, CAST(n AS INT) AS fact_no, f.fact AS fact FROM (SELECT document_id, sequence_index, summary_id, unnest(key_facts[1:3]) AS f, generate_subscripts(key_facts[1:3], 1) - 1 AS n FROM su) ORDER BY document_id, sequence_index, summary_id, n LIMIT 200")
def top_facts_limited(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.first_facts(V.summaries(spark, d)).select("summary_id", "fact_no", "fact")


@query(f"""WITH {V.SECTIONS} SELECT draft_id, md5(string_agg(repeat('#', greatest(coalesce(level, 1), 1)) || ' ' || coalesce(heading, '') || chr(10) || chr(10) || coalesce(content, ''), chr(10) || chr(10) ORDER BY pos, section_id)) AS digest FROM se GROUP BY 1""")
def draft_text(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.draft_text(V.sections(spark, d)).select("draft_id", F.md5("text").alias("digest"))


@query(f"""WITH {V.SECTIONS} SELECT heading, version, section_id FROM se WHERE heading IS NOT NULL QUALIFY row_number() OVER (PARTITION BY heading ORDER BY version DESC NULLS LAST, created_at DESC NULLS LAST, section_id DESC) = 1""")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    rows = V.sections(spark, d).filter("heading is not null").select("heading", "section_id", "version", "created_at")
    return state.latest(rows.withColumn("order", F.struct("version", "created_at", "section_id")), "heading", "order").select("heading", "version", "section_id")


# Enrichment


@query()
def enrich_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk with the answer of the deterministic stand-in provider."""
    answers = enrich.enrich(synthesis.chunk_prompt(V.chunks(spark, d)), "chunk_id", "prompt")
    return enrich.fallback(answers).select("chunk_id", "status", "tries", "confidence", F.length("summary").alias("n_chars"))


# Usage


@query("SELECT agent, model, count(*) AS n_rows, CAST(sum(coalesce(len(chunk_ids), 0)) AS BIGINT) AS sum_n FROM (SELECT DISTINCT record_id, agent, model, chunk_ids FROM provenance_records) GROUP BY GROUPING SETS ((agent), (agent, model), ())")
def audit_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provenance_records").select("record_id", "agent", "model", "chunk_ids").distinct().withColumn("n", F.greatest(F.coalesce(F.size("chunk_ids"), F.lit(0)), F.lit(0)))
    return usage.totals(rows, [["agent"], ["agent", "model"], []], ["n"])


@query("SELECT event_type, count(*) AS n_rows, round(sum(value), 4) AS sum_value FROM events GROUP BY ROLLUP (event_type)")
def usage_rollup(spark: SparkSession, d: str) -> DataFrame:
    return usage.totals(table(spark, d, "events"), [["event_type"], []], ["value"]).withColumn("sum_value", F.round("sum_value", 4))


_COUNTER = "e AS (SELECT event_id, user_id, ts, CAST(floor(value) AS BIGINT) AS c FROM events)"


@query(f"WITH {_COUNTER}, g AS (SELECT *, c - lag(c, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grown FROM e) SELECT event_id, CASE WHEN grown < 0 THEN c ELSE grown END AS d_c FROM g WHERE CASE WHEN grown < 0 THEN c ELSE grown END > 0")
def cumulative_delta(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("c", F.floor("value").cast("long"))
    return usage.deltas(e, ["user_id"], ["ts", "event_id"], ["c"]).select("event_id", "d_c")


@query(f"WITH {_COUNTER} SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS total_c FROM e")
def running_usage(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("c", F.floor("value").cast("long"))
    return usage.running(e, ["user_id"], ["ts", "event_id"], ["c"]).select("event_id", "total_c")


_STREAK = """WITH i AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
s AS (SELECT event_id, user_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS INT) AS streak FROM i)"""


@query(f"{_STREAK} SELECT event_id, streak FROM s")
def rate_limit_streak(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return usage.streaks(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") == "purchase").select("event_id", "streak")


@query(f"{_STREAK} SELECT user_id, max(streak) AS longest, count(*) AS n_rows FROM s GROUP BY 1")
def longest_streaks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return usage.longest_streaks(usage.streaks(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") == "purchase"), ["user_id"])


# State


@query(f"""WITH {V.ARTIFACTS} SELECT artifact_id, coalesce(starts_with(status, 'failed_'), false) AS failed, status IS NULL OR status = 'pending' OR starts_with(status, 'failed_') AS pending,
artifact_type IN ('image', 'chart', 'map') AND CASE WHEN status = 'success' THEN false WHEN starts_with(status, 'failed_') THEN true WHEN length(content) = 0 THEN true ELSE coalesce(status IS NULL AND confidence <= 0.3, false) END AS failed_image FROM art""")
def failed_predicate(spark: SparkSession, d: str) -> DataFrame:
    a = V.artifacts(spark, d)
    return a.select("artifact_id", state.is_failed(F.col("status")).alias("failed"), state.needs_processing(F.col("status")).alias("pending"), state.is_failed_image(F.col("artifact_type"), F.col("status"), F.col("confidence"), F.length("content") > 0).alias("failed_image"))


@query(f"WITH {V.ARTIFACTS} SELECT artifact_id, round(confidence, 6) AS confidence FROM art WHERE artifact_type IN ('image', 'chart', 'map') AND status = 'success' AND confidence < 0.8")
def low_confidence(spark: SparkSession, d: str) -> DataFrame:
    return V.artifacts(spark, d).filter(state.is_low_confidence_image(F.col("artifact_type"), F.col("status"), F.col("confidence"), 0.8)).select("artifact_id", r6(F.col("confidence"), "confidence"))


@query(f"WITH {V.SUMMARIES}, {V.CHUNKS} SELECT chunk_id FROM ch WHERE {V.CLEAN.format('chunk_id')} NOT IN (SELECT {V.CLEAN.format('chunk_id')} FROM su WHERE chunk_id IS NOT NULL)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return state.pending(V.chunks(spark, d), V.summaries(spark, d), "chunk_id").select("chunk_id")


@query(f"WITH {V.SUMMARIES}, {V.CHUNKS} SELECT chunk_id FROM ch WHERE {V.CLEAN.format('chunk_id')} NOT IN (SELECT {V.CLEAN.format('chunk_id')} FROM su WHERE chunk_id IS NOT NULL AND confidence > 0.7 AND NOT starts_with(summary, '[failed'))")
def retry_pending(spark: SparkSession, d: str) -> DataFrame:
    good = V.summaries(spark, d).filter((F.col("confidence") > 0.7) & ~F.startswith("summary", F.lit("[failed")))
    return state.pending(V.chunks(spark, d), good, "chunk_id").select("chunk_id")


@query("WITH t AS (SELECT DISTINCT source.source_file AS source_file FROM artifacts WHERE source.source_file IS NOT NULL) SELECT source_file, source_file IN (SELECT source_file FROM parse_results WHERE source_file IS NOT NULL) AS is_stored FROM t")
def already_parsed(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "artifacts").select(F.col("source.source_file").alias("source_file")).filter("source_file is not null").distinct()
    return state.reused_and_new(files, table(spark, d, "parse_results"), "source_file")


@query("""WITH v AS (SELECT artifact_id, artifact_type, coalesce(starts_with(metadata['status'], 'failed_'), false) AS failed, row_number() OVER (PARTITION BY artifact_id ORDER BY delivered_at) AS a, row_number() OVER (PARTITION BY artifact_id ORDER BY delivered_at DESC) AS z FROM artifacts)
SELECT b.artifact_type, count(*) AS n_failed, count(*) FILTER (NOT l.failed) AS n_recovered, count(*) FILTER (l.failed) AS n_still FROM (SELECT * FROM v WHERE a = 1 AND failed) b JOIN (SELECT * FROM v WHERE z = 1) l USING (artifact_id) GROUP BY 1""")
def retry_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "artifacts").select("artifact_id", "artifact_type", "delivered_at", state.is_failed(F.try_element_at("metadata", F.lit("status"))).alias("failed"))
    first = rows.groupBy("artifact_id").agg(F.min_by("failed", "delivered_at").alias("failed"), F.min_by("artifact_type", "delivered_at").alias("artifact_type"))
    last = rows.groupBy("artifact_id").agg(F.max_by("failed", "delivered_at").alias("failed"))
    return state.retry_summary(first, last, "artifact_id", ["artifact_type"])


# Relations of the companion set: built-in operators of Spark and two joins of this package, for tables of orders and events.


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def r_pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("sum_disc"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))


@query("SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def r_star_join(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    by_customer = o.groupBy("o_custkey").agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("s"))
    joined = by_customer.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum("k").alias("n_orders"), F.round(F.sum("s"), 2).alias("total"))


@query("""SELECT c.event_id, p.value AS asof_value FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def r_asof_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    bought = e.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return relational.asof_join(e.filter("event_type = 'click'").select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", ["value"]).select("event_id", "asof_value")


@query("""WITH s AS (SELECT event_id AS signup_id, user_id, ts AS b, ts + INTERVAL 2 DAY AS e FROM events WHERE event_type = 'signup') SELECT ev.event_id, signup_id FROM events ev JOIN s ON ev.user_id = s.user_id AND ev.ts >= s.b AND ev.ts < s.e WHERE ev.event_type = 'purchase'""")
def r_interval_join(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    spans = e.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "user_id", F.col("ts").alias("b"), (F.col("ts") + F.expr("interval 2 days")).alias("e"))
    return relational.interval_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), spans, ["user_id"], "ts", "b", "e", 86_400).select("event_id", "signup_id")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def r_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"))


@query("SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1")
def r_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact, and no group is held in one task: see relational.quantiles."""
    out = relational.quantiles(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", {"median": 0.5, "p90": 0.9})
    return out.select("o_orderpriority", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@query("(SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) EXCEPT SELECT s_suppkey FROM supplier")
def r_intersect_except(spark: SparkSession, d: str) -> DataFrame:
    k = lambda t, c: table(spark, d, t).select(F.col(c).alias("k"))
    return k("customer", "c_custkey").intersect(k("orders", "o_custkey")).subtract(k("supplier", "s_suppkey"))


@query()
def r_approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("about"))


@query(f"WITH {V.CHUNKS} SELECT chunk_id, md5(concat_ws(chr(10), 'Source: ' || coalesce(source_file, ''), 'Section: ' || coalesce(array_to_string(heading_path, ' > '), ''), CASE WHEN contains_tables THEN 'It holds tables.' END, CASE WHEN contains_images THEN 'It holds descriptions of images.' END, '', coalesce(content, ''))) AS digest FROM ch")
def chunk_prompts(spark: SparkSession, d: str) -> DataFrame:
    return synthesis.chunk_prompt(V.chunks(spark, d)).select("chunk_id", F.md5("prompt").alias("digest"))


@query(f"WITH {V.SUMMARIES} SELECT summary_id, round(abs(coalesce(confidence, 0) - 0.8) / 0.8, 6) AS error FROM su")
def relative_errors(spark: SparkSession, d: str) -> DataFrame:
    return V.summaries(spark, d).select("summary_id", r6(T.relative_error(F.coalesce("confidence", F.lit(0.0)), F.lit(0.8)), "error"))
