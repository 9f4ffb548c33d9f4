"""Queries on sections, chunks, texts and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.operators import chunking, sections, synthesis
from tessella.queries import views as V
from tessella.tables import table

BUDGET, OVERLAP = 120, 20

_SECTIONS = f"""
WITH RECURSIVE {V.ARTIFACTS},
rn AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY pos) AS rn FROM art),
flag AS (SELECT *, is_heading AND coalesce(heading_level, 0) <= 2 AND rn > 1 AS begins FROM rn),
no AS (SELECT *, CAST(sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY pos) AS INT) AS section_no FROM flag),
sec AS (SELECT *, coalesce(max(CASE WHEN begins THEN content END) OVER (PARTITION BY document_id, section_no), 'Introduction') AS section_title,
        greatest(1, length(content) // 4) AS n_tokens, row_number() OVER (PARTITION BY document_id, section_no ORDER BY pos) AS k FROM no)
"""
_PACKED = f"""{_SECTIONS},
pack AS (
  SELECT document_id, section_no, k, artifact_id, n_tokens AS used, 0 AS chunk_no FROM sec WHERE k = 1
  UNION ALL
  SELECT s.document_id, s.section_no, s.k, s.artifact_id,
         CASE WHEN p.used + s.n_tokens > {BUDGET} THEN s.n_tokens ELSE p.used + s.n_tokens END,
         CASE WHEN p.used + s.n_tokens > {BUDGET} THEN p.chunk_no + 1 ELSE p.chunk_no END
  FROM pack p JOIN sec s ON s.document_id = p.document_id AND s.section_no = p.section_no AND s.k = p.k + 1),
packed AS (SELECT sec.*, pack.chunk_no FROM sec JOIN pack USING (document_id, section_no, k))
"""
_CHUNKS = f"""{_PACKED},
own AS (SELECT document_id, section_no, section_title, chunk_no, string_agg(content, chr(10) || chr(10) ORDER BY pos) AS own, list(artifact_id ORDER BY pos) AS artifact_ids,
        sum(n_tokens) AS n_artifact_tokens, bool_or(artifact_type = 'table') AS contains_tables, bool_or(artifact_type IN ('image', 'chart', 'map')) AS contains_images
        FROM packed GROUP BY ALL),
lagged AS (SELECT *, lag(own) OVER (PARTITION BY document_id, section_no ORDER BY chunk_no) AS prev, row_number() OVER (PARTITION BY document_id ORDER BY section_no, chunk_no) - 1 AS sequence_index FROM own),
full_text AS (SELECT *, CASE WHEN coalesce(prev, '') = '' THEN own ELSE right(prev, {4 * OVERLAP}) || chr(10) || chr(10) || own END AS full_text FROM lagged),
chunk AS (SELECT *, greatest(1, length(full_text) // 4) AS token_count, trim(full_text, ' ' || chr(9) || chr(13) || chr(10)) AS content FROM full_text)
"""
_STACK = """
stack AS (
  SELECT {keys}, k, {id} AS row_id, {first} AS path FROM {rows} WHERE k = 1
  UNION ALL
  SELECT {rkeys}, r.k, r.{id}, {next} FROM stack s JOIN {rows} r ON {on} AND r.k = s.k + 1)
"""


def section_ids(spark: SparkSession, d: str) -> DataFrame:
    return sections.with_sections(V.artifacts(spark, d)).select("document_id", "artifact_id", "section_no", "section_title")


def pack_budget(spark: SparkSession, d: str) -> DataFrame:
    return chunking.pack(sections.with_sections(V.artifacts(spark, d)), BUDGET).select("artifact_id", "section_no", "n_tokens", "chunk_no")


def _chunked(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunks(V.artifacts(spark, d), BUDGET, OVERLAP)


def chunk_assemble(spark: SparkSession, d: str) -> DataFrame:
    return _chunked(spark, d).select("document_id", "sequence_index", "section_no", "section_title", "chunk_no", "content", "token_count", "contains_tables", "contains_images", F.array_join("artifact_ids", ",").alias("artifact_ids"))


def overlap_prefix(spark: SparkSession, d: str) -> DataFrame:
    """How much each chunk's text grew by its overlap."""
    return _chunked(spark, d).select("document_id", "sequence_index", "token_count", "n_artifact_tokens")


def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_stats(chunking.chunk_sizes(V.artifact_sizes(spark, d), BUDGET, OVERLAP), "document_id").select("document_id", "n_chunks", "sum_tokens", "avg_tokens", "min_tokens", "max_tokens")


def heading_path(spark: SparkSession, d: str) -> DataFrame:
    headings = V.artifacts(spark, d).filter("is_heading")
    return sections.heading_stack(headings).select("artifact_id", F.array_join("path", " > ").alias("path"))


def heading_path_chunker(spark: SparkSession, d: str) -> DataFrame:
    return sections.section_paths(sections.with_sections(V.artifacts(spark, d))).select("artifact_id", F.array_join("heading_path", " > ").alias("path"))


def markdown_sections(spark: SparkSession, d: str) -> DataFrame:
    return sections.markdown_sections(table(spark, d, "documents"), "doc_id", "text")


def prefix_budget(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    return synthesis.prefix_within(docs, ["source"], ["doc_id"], F.col("n_chars"), 30_000)


def line_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as artifacts, blank ones left out."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("btrim(line) <> ''")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.max("pos").alias("last_pos"))


def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("n_tokens"))


def word_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


def number_extract(spark: SparkSession, d: str) -> DataFrame:
    """Numbers and units in the texts of draft sections."""
    return V.sections(spark, d).select("section_id", F.posexplode(T.numbers(F.col("content"))).alias("n", "x")).select("section_id", "n", "x.value", "x.unit")


def number_normalize(spark: SparkSession, d: str) -> DataFrame:
    digits = V.sections(spark, d).select(F.explode(F.regexp_extract_all("content", F.lit(r"([0-9][0-9.,]*[0-9]|[0-9])"), F.lit(1))).alias("digits")).distinct()
    return digits.select("digits", T.number(F.col("digits")).alias("plain"), T.number(F.col("digits"), "local").alias("local"))


def slug(spark: SparkSession, d: str) -> DataFrame:
    return V.sections(spark, d).select("section_id", T.slug(F.col("heading")).alias("slug"))


def heading_level(spark: SparkSession, d: str) -> DataFrame:
    """Levels read back from styles that are spelled in several ways; a style may lack its number or have more words."""
    begin = F.get(F.array(*(F.lit(x) for x in T.HEADING_STYLES)), F.length("artifact_id") % len(T.HEADING_STYLES))
    style = F.when(F.col("is_heading"), F.concat_ws(" ", begin, F.when(F.col("pos") % 2 == 0, "Char"), F.col("heading_level").cast("string"), F.lit("x 9"))).otherwise(F.concat(F.lit("Normal "), F.col("pos").cast("string")))
    return V.artifacts(spark, d).select("artifact_id", T.is_heading_style(style).alias("is_heading"), T.heading_level(style).alias("level"))


def table_text(spark: SparkSession, d: str) -> DataFrame:
    rows = V.artifacts(spark, d).filter("size(table_data) > 0")
    return rows.select("artifact_id", T.table_text(F.col("table_data"), F.array_sort(F.map_keys(F.get("table_data", 0)))).alias("text"))


def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    """Answers with text around nested JSON; every fourth is cut off before its last brace and has none."""
    nested = F.concat(F.lit('Answer: {"a": '), "props", F.when(F.col("event_id") % 4 == 0, "").otherwise("}"), F.lit(" (end)"))
    whole = T.json_between_braces(nested)
    found = F.get_json_object(whole, "$.a")
    return table(spark, d, "events").select("event_id", found.alias("json"), F.get_json_object(found, "$.k").cast("int").alias("k"))


def excerpts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provenance_records").select("record_id", T.excerpt(F.col("original_excerpt"), 60).alias("excerpt")).distinct()


QUERIES = {f.__name__: f for f in (chunk_stats, section_ids, pack_budget, chunk_assemble, overlap_prefix, heading_path, heading_path_chunker, markdown_sections, prefix_budget, line_artifacts, token_estimate, word_count, number_extract, number_normalize, slug, heading_level, table_text, json_salvage, excerpts)}

_HEADINGS = f"WITH RECURSIVE {V.ARTIFACTS}, hd AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY pos) AS k, greatest(coalesce(heading_level, 1), 1) AS lvl FROM art WHERE is_heading), "
_RAW = "regexp_replace(lower(trim(heading, ' ')), '[^\\p{L}\\p{N}_\\s-]', '', 'g')"

SQL = {
    "section_ids": f"{_SECTIONS} SELECT document_id, artifact_id, section_no, section_title FROM sec",
    "pack_budget": f"{_PACKED} SELECT artifact_id, section_no, CAST(n_tokens AS INT) AS n_tokens, chunk_no FROM packed",
    "chunk_assemble": f"{_CHUNKS} SELECT document_id, CAST(sequence_index AS INT) AS sequence_index, section_no, section_title, chunk_no, content, CAST(token_count AS INT) AS token_count, contains_tables, contains_images, array_to_string(artifact_ids, ',') AS artifact_ids FROM chunk",
    "overlap_prefix": f"{_CHUNKS} SELECT document_id, CAST(sequence_index AS INT) AS sequence_index, CAST(token_count AS INT) AS token_count, CAST(n_artifact_tokens AS INT) AS n_artifact_tokens FROM chunk",
    "chunk_stats": f"{_CHUNKS} SELECT document_id, count(*) AS n_chunks, CAST(sum(token_count) AS BIGINT) AS sum_tokens, CAST(sum(token_count) // count(*) AS BIGINT) AS avg_tokens, CAST(min(token_count) AS INT) AS min_tokens, CAST(max(token_count) AS INT) AS max_tokens FROM chunk GROUP BY 1",
    "heading_path": _HEADINGS
    + _STACK.format(keys="document_id", id="artifact_id", first="[content]", rows="hd", rkeys="r.document_id", next="list_append(s.path[1:r.lvl - 1], r.content)", on="r.document_id = s.document_id")
    + "SELECT row_id AS artifact_id, array_to_string(path, ' > ') AS path FROM stack",
    "heading_path_chunker": _SECTIONS
    + ", "
    + _STACK.format(
        keys="document_id, section_no",
        id="artifact_id",
        first="CASE WHEN is_heading THEN list_append([section_title][1:greatest(coalesce(heading_level, 1), 1) - 1], content) ELSE [section_title] END",
        rows="sec",
        rkeys="r.document_id, r.section_no",
        next="CASE WHEN r.is_heading THEN list_append(s.path[1:greatest(coalesce(r.heading_level, 1), 1) - 1], r.content) ELSE s.path END",
        on="r.document_id = s.document_id AND r.section_no = s.section_no",
    )
    + "SELECT row_id AS artifact_id, array_to_string(path, ' > ') AS path FROM stack",
    "markdown_sections": """
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL),
marked AS (SELECT doc_id, n, trim(line, ' ') AS line, starts_with(trim(line, ' '), '#') AS h, greatest(sum(CASE WHEN starts_with(trim(line, ' '), '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n), 1) AS section_no FROM lines),
grouped AS (SELECT doc_id, section_no, max(CASE WHEN h THEN line END) AS raw, string_agg(CASE WHEN NOT h THEN line END, chr(10) ORDER BY n) AS body FROM marked GROUP BY 1, 2)
SELECT doc_id, CAST(section_no AS INT) AS section_no, trim(regexp_replace(raw, '^#+', ''), ' ') AS heading, CAST(length(regexp_extract(raw, '^(#+)', 1)) AS INT) AS level, trim(body, ' ' || chr(10)) AS content FROM grouped WHERE raw IS NOT NULL AND body IS NOT NULL""",
    "prefix_budget": "SELECT * FROM (SELECT source, doc_id, n_chars, CAST(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS running FROM documents) WHERE running <= 30000",
    "line_artifacts": "SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, CAST(max(n) AS INT) AS last_pos FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents WHERE text IS NOT NULL) WHERE trim(line, ' ') <> '' GROUP BY 1",
    "token_estimate": "SELECT doc_id, CAST(greatest(1, length(coalesce(text, '')) // 4) AS INT) AS n_tokens FROM documents",
    "word_count": r"SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\t-\r \x{85}\p{Z}]+')) AS INT) AS n_words FROM documents",
    "number_normalize": f"""
WITH {V.SECTIONS}, t AS (SELECT DISTINCT unnest(regexp_extract_all(content, '[0-9][0-9.,]*[0-9]|[0-9]')) AS digits FROM se),
w AS (SELECT digits, CASE WHEN contains(digits, ',') AND contains(digits, '.') AND strpos(reverse(digits), ',') < strpos(reverse(digits), '.') THEN replace(replace(digits, '.', ''), ',', '.')
  WHEN contains(digits, ',') AND contains(digits, '.') THEN replace(digits, ',', '') WHEN regexp_matches(digits, '^[^,]*,[0-9]{{0,2}}$') THEN replace(digits, ',', '.') ELSE replace(digits, ',', '') END AS written FROM t)
SELECT digits, coalesce(try_cast(digits AS DOUBLE), try_cast(written AS DOUBLE)) AS plain,
  try_cast(CASE WHEN regexp_matches(digits, '^[0-9]{{1,3}}(\\.[0-9]{{3}})+(,[0-9]+)?$') THEN replace(replace(digits, '.', ''), ',', '.') ELSE written END AS DOUBLE) AS local FROM w""",
    "slug": f"WITH {V.SECTIONS} SELECT section_id, coalesce(nullif(substring(regexp_replace({_RAW}, '[\\s_]+', '_', 'g'), 1, 80), ''), 'section') AS slug FROM se",
    "heading_level": f"WITH {V.ARTIFACTS} SELECT artifact_id, is_heading, CASE WHEN is_heading THEN coalesce(heading_level, 9) ELSE pos END AS level FROM art",
    "table_text": f"""WITH {V.ARTIFACTS}, h AS (SELECT artifact_id, table_data, list_sort(map_keys(table_data[1])) AS head FROM art WHERE len(table_data) > 0)
SELECT artifact_id, array_to_string(list_concat([array_to_string(head, ' | '), array_to_string(list_transform(head, lambda x: repeat('-', length(x))), ' | ')],
  list_transform(table_data, lambda r: array_to_string(list_transform(head, lambda x: coalesce(r[x], '')), ' | '))), chr(10)) AS text FROM h""",
    "json_salvage": "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN replace(props, ' ', '') END AS json, CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INT) END AS k FROM events",
    "excerpts": "SELECT DISTINCT record_id, substring(original_excerpt, 1, 60) AS excerpt FROM provenance_records",
}
