"""Queries on what stands around the stages: readers, stores, answers of models, texts for models, archives, state."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.functions import text as T
from tessella.operators import answers, parsing, quality, retrieval, state, synthesis, usage
from tessella.queries import views as V
from tessella.queries.analysis import ANNOTATIONS, _annotations, query
from tessella.sources import archive, documents, store
from tessella.streaming import windows
from tessella.tables import shared_folder, table


def _store(spark: SparkSession) -> store.Store:
    """A new store in the shared folder."""
    return store.Store(spark, os.path.join(shared_folder(spark), f"store-{uuid.uuid4().hex}"))


def _kept(spark: SparkSession, df: DataFrame, partition_by: list[str] | None = None) -> store.Store:
    kept = _store(spark)
    kept.save("t", df, partition_by=partition_by)
    return kept


# Readers

_LINES = "ln AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents WHERE text IS NOT NULL)"


@query(f"WITH {_LINES} SELECT doc_id || '.txt' AS source_file, count(*) AS n_artifacts FROM ln WHERE regexp_matches(line, '[^\\t-\\r\\x1c-\\x20\\x{{85}}\\p{{Z}}]') GROUP BY 1")
def text_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Documents as text files, read by the reader of text files."""
    files = table(spark, d, "documents").select(F.concat(F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.encode("text", "utf-8").alias("content")).filter("content is not null")
    return documents.read_documents(files, documents.parse_text).groupBy("source_file").agg(F.count("*").alias("n_artifacts"))


@query("""SELECT document_id || '.html' AS source_file, count(*) AS n_artifacts, count(*) FILTER (h) AS n_headings FROM (SELECT document_id, trim(h.text, ' ') <> '' AS keep, true AS h FROM (SELECT document_id, unnest(heading_structure) AS h FROM (SELECT document_id, max(heading_structure) AS heading_structure FROM parse_results GROUP BY 1))
  UNION ALL SELECT document_id, true, false FROM (SELECT DISTINCT document_id FROM parse_results)) WHERE keep GROUP BY 1""")
def html_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Headings of parse results written as HTML pages, with a paragraph, read by the reader of HTML."""
    one = table(spark, d, "parse_results").groupBy("document_id").agg(F.max("heading_structure").alias("h"))
    escaped = lambda t: F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.array_join(F.transform(F.coalesce("h", F.expr("array()")), lambda x: F.concat(F.lit("<h2>"), escaped(F.coalesce(x["text"], F.lit(""))), F.lit("</h2>"))), "")
    files = one.select(F.concat(F.lit("/"), "document_id", F.lit(".html")).alias("path"), F.encode(F.concat(F.lit("<html><script>var x = '<p>';</script><p>Texto"), F.lit("</p>"), body, F.lit("</html>")), "utf-8").alias("content"))
    return documents.read_documents(files, documents.parse_html).groupBy("source_file").agg(F.count("*").alias("n_artifacts"), F.count_if("is_heading").alias("n_headings"))


@query(f"""WITH {V.ARTIFACTS} SELECT document_id, CAST(coalesce(sum(length(content)) FILTER ((artifact_type = 'text' AND NOT is_heading) OR artifact_type = 'table'), 0) AS BIGINT) AS total_text_length,
  count(*) FILTER (artifact_type = 'table') AS total_tables, count(*) FILTER (artifact_type = 'image') AS total_images, count(*) FILTER (is_heading) AS n_headings FROM art GROUP BY 1""")
def document_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = V.artifacts(spark, d).withColumn("source_file", F.lit("")).withColumn("heading_path", F.array().cast("array<string>"))
    return documents.document_totals(rows).select("document_id", "total_text_length", "total_tables", "total_images", F.size("heading_structure").cast("long").alias("n_headings"))


@query("SELECT span, CASE WHEN size >= 20 THEN 1 WHEN size >= 16 THEN 2 WHEN size >= 14 AND bold THEN 3 END AS level FROM (SELECT entry_id AS span, 8 + abs(entry_id) % 16 AS size, entry_id % 3 = 0 AS bold FROM (SELECT DISTINCT entry_id FROM numeric_entries))")
def font_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels of headings by font size and weight, over made-up spans."""
    spans = table(spark, d, "numeric_entries").select(F.col("entry_id").alias("span")).distinct()
    return spans.select("span", documents.font_heading(8 + F.abs("span") % 16, F.col("span") % 3 == 0).alias("level"))


# Stores: what is saved is loaded again


@query("SELECT document_id, count(*) AS n_rows, max(total_text_length) AS length FROM parse_results GROUP BY 1")
def store_parse_results(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, table(spark, d, "parse_results")).load("t").groupBy("document_id").agg(F.count("*").alias("n_rows"), F.max("total_text_length").alias("length"))


@query(f"WITH {V.CHUNKS} SELECT chunk_id, document_id, token_count, md5(content) AS digest FROM ch")
def store_chunks(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, V.chunks(spark, d)).load("t").select("chunk_id", "document_id", "token_count", F.md5("content").alias("digest"))


@query(f"WITH {V.CHUNKS}, one AS (SELECT document_id FROM ch GROUP BY 1 ORDER BY count(*) DESC, document_id LIMIT 1) SELECT chunk_id, sequence_index FROM ch JOIN one USING (document_id)")
def store_chunks_of_document(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the largest document, from a store partitioned by document: only its folder is read."""
    chunks = V.chunks(spark, d)
    largest = chunks.groupBy("document_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "document_id").first()
    return _kept(spark, chunks, ["document_id"]).where("t", document_id=largest["document_id"] if largest else "").select("chunk_id", "sequence_index")


@query(f"WITH {V.SUMMARIES} SELECT summary_id, chunk_id, round(confidence, 6) AS confidence, CAST(coalesce(len(key_facts), 0) AS INT) AS n_facts FROM su")
def store_summaries(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, V.summaries(spark, d)).load("t").select("summary_id", "chunk_id", F.round("confidence", 6).alias("confidence"), F.greatest(F.coalesce(F.size("key_facts"), F.lit(0)), F.lit(0)).alias("n_facts"))


@query(f"WITH {V.SECTIONS} SELECT section_id, version, md5(content) AS digest FROM se WHERE version = 2")
def store_draft_version(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, V.sections(spark, d), ["version"]).version("t", 2).select("section_id", F.col("version").cast("int").alias("version"), F.md5("content").alias("digest"))


@query(f"WITH {V.SECTIONS} SELECT section_id FROM se WHERE version = (SELECT coalesce(min(version) FILTER (version = 1), min(version)) FROM se)")
def store_first_draft(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, V.sections(spark, d)).first_version("t").select("section_id")


@query(f"WITH {V.SECTIONS} SELECT section_id FROM se WHERE version = (SELECT max(version) FROM se)")
def store_last_draft(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, V.sections(spark, d)).last_version("t").select("section_id")


@query(f"WITH {V.SECTIONS} SELECT draft_id, count(*) AS n_sections, min(heading) AS first_heading FROM se WHERE heading IS NOT NULL GROUP BY 1")
def store_draft_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections by the slug of their heading in a store that a second save of a draft replaces."""
    sections = V.sections(spark, d).filter("heading is not null").withColumn("slug", T.slug(F.col("heading")))
    kept = _kept(spark, sections.limit(0))
    kept.save("t", sections)
    return kept.load("t").groupBy("draft_id").agg(F.count("*").alias("n_sections"), F.min("heading").alias("first_heading"))


@query(f"WITH {V.SECTIONS}, {ANNOTATIONS} SELECT draft_id, section_id, verdict, risk_level FROM an")
def store_reviews(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, _annotations(spark, d)).load("t").select("draft_id", "section_id", "verdict", "risk_level")


@query("SELECT stage, 2 * n AS n_rows FROM (SELECT agent AS stage, count(*) AS n FROM (SELECT DISTINCT record_id, agent FROM provenance_records) GROUP BY 1)")
def audit_log(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the audit log of a stage, appended twice as JSON lines and read with a schema."""
    rows = table(spark, d, "provenance_records").select("record_id", "agent", "chunk_ids").groupBy("record_id", "agent").agg(F.max("chunk_ids").alias("chunk_ids"))
    made = parsing.audit_rows(rows, "stage", F.col("agent"), "wrote", F.col("record_id"), F.col("chunk_ids"), F.size("chunk_ids"), F.lit(None))
    log = _store(spark)
    log.append("log", made)
    log.append("log", made)
    return log.log("log", made.schema).groupBy(F.col("agent").alias("stage")).agg(F.count("*").alias("n_rows"))


@query(f"WITH {V.SECTIONS} SELECT section_id, n % 2 = 0 AS is_reviewed FROM (SELECT section_id, length(section_id) + coalesce(pos, 0) AS n FROM se)")
def review_markers(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("section_id") + F.coalesce("pos", F.lit(0))
    texts = V.sections(spark, d).select("section_id", F.concat(F.lit("Notas\n"), F.when(n % 4 == 0, "Reviewed: yes").when(n % 4 == 2, "approved by x").otherwise("REVIEWED: NO")).alias("t"))
    return texts.select("section_id", T.is_reviewed(F.col("t")).alias("is_reviewed"))


@query(f"WITH {V.SECTIONS} SELECT md5(string_agg(coalesce(heading, ''), chr(10) ORDER BY section_id) || chr(10)) AS digest FROM se")
def store_text(spark: SparkSession, d: str) -> DataFrame:
    """A text file of headings in order, written and read whole."""
    kept = _store(spark)
    kept.save_text("file", V.sections(spark, d), "section_id", "heading")
    return kept.load_text("file").select(F.md5("value").alias("digest"))


@query(f"WITH {V.CHUNKS} SELECT chunk_id, token_count FROM ch")
def json_objects(spark: SparkSession, d: str) -> DataFrame:
    """Chunks as JSON lines, read with a schema; broken objects are left out."""
    kept = _store(spark)
    V.chunks(spark, d).select(F.to_json(F.struct("chunk_id", "token_count")).alias("value")).unionByName(spark.createDataFrame([('{"chunk_id": "broken", "token_count": ',)], "value string")).write.text(kept.path("objects"))
    schema = StructType.fromDDL("chunk_id string, token_count int, _corrupt_record string")
    return kept.log("objects", schema).filter("_corrupt_record is null").select("chunk_id", "token_count")


@query(f"WITH {V.SUMMARIES} SELECT summary_id, summary FROM su")
def store_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Summaries that arrive in two halves, the later versions win."""
    rows = table(spark, d, "chunk_summaries").select("summary_id", "summary", "summarized_at")
    kept = _store(spark)
    half = F.pmod(F.xxhash64("summary_id", "summarized_at"), F.lit(2)) == 0
    kept.upsert("t", rows.filter(half), "summary_id", "summarized_at")
    kept.upsert("t", rows.filter(~half), "summary_id", "summarized_at")
    return kept.load("t").select("summary_id", "summary")


@query(f"WITH {V.ARTIFACTS} SELECT artifact_id, document_id, length(content) AS n_chars FROM art")
def vector_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "artifacts").select("artifact_id", "delivered_at", "document_id", F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"))
    half = F.pmod(F.xxhash64("artifact_id", "delivered_at"), F.lit(2)) == 0
    return retrieval.upsert(rows.filter(half), rows.filter(~half), "artifact_id", "delivered_at").select("artifact_id", "document_id", "n_chars")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Events by micro-batches into a store, each key once."""
    kept = _store(spark)
    events = windows.event_stream(spark, d, "events.parquet", table(spark, d, "events").schema)
    windows.run_batches(events, lambda batch, _: kept.upsert("t", batch.select("event_id", "ts", "user_id", "event_type"), "event_id", "ts"), kept.path("offsets"))
    return kept.load("t").select("event_id", "user_id", "event_type")


@query("SELECT user_id, CAST(sum(CASE WHEN c < p THEN c ELSE c - p END) AS BIGINT) AS grown FROM (SELECT user_id, c, lag(c, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM (SELECT *, CAST(floor(value) AS BIGINT) AS c FROM events)) GROUP BY 1")
def stream_counters(spark: SparkSession, d: str) -> DataFrame:
    """What a cumulative counter of each user grew by, by a stateful stream."""
    events = windows.event_stream(spark, d, "events.parquet", table(spark, d, "events").schema).withColumn("c", F.floor("value").cast("long"))
    out = windows.run_to_folder(windows.counter_state(events, "user_id", "ts", "c"), "update")
    return out.groupBy("user_id").agg(F.sum("grown").alias("grown"))


# Archives

_PATHS = "f AS (SELECT source_file, 'output/' || CASE WHEN contains(lower(source_file), '.pdf') THEN 'images/' ELSE 'chunks/' END || source_file AS path, count(*) AS size FROM artifacts_files GROUP BY 1)".replace("artifacts_files", "(SELECT source.source_file AS source_file FROM artifacts WHERE source.source_file IS NOT NULL)")


def _listing(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("source.source_file")
    rows = table(spark, d, "artifacts").select(name.alias("source_file")).filter("source_file is not null").groupBy("source_file").agg(F.count("*").alias("size"))
    return rows.select(F.concat(F.lit("output/"), F.when(F.contains(F.lower("source_file"), F.lit(".pdf")), "images/").otherwise("chunks/"), "source_file").alias("path"), "size")


@query(f"WITH {_PATHS} SELECT path, size FROM f WHERE starts_with(path, 'output/') AND NOT starts_with(path, 'output/images/')")
def archive_files(spark: SparkSession, d: str) -> DataFrame:
    return archive.chosen(_listing(spark, d), ["output/"], ["output/images/*"])


@query(f"WITH {_PATHS} SELECT count(*) AS n_files, CAST(sum(size) AS BIGINT) AS total_size, md5(string_agg(path, ',' ORDER BY path)) AS digest FROM f")
def archive_manifest(spark: SparkSession, d: str) -> DataFrame:
    m = archive.manifest(_listing(spark, d))
    return m.select("n_files", "total_size", F.md5(F.array_join(F.transform("files", lambda x: x["path"]), ",")).alias("digest"))


# Predicates


@query(f"WITH {V.ARTIFACTS} SELECT artifact_id FROM (SELECT artifact_id, artifact_type, image_base64 FROM artifacts QUALIFY row_number() OVER (PARTITION BY artifact_id ORDER BY delivered_at DESC NULLS LAST) = 1) WHERE artifact_type = 'image' AND image_base64 IS NOT NULL")
def image_targets(spark: SparkSession, d: str) -> DataFrame:
    last = state.latest(table(spark, d, "artifacts").select("artifact_id", "delivered_at", "artifact_type", F.col("image_base64").alias("image")), "artifact_id", "delivered_at")
    return answers.image_targets(last, last.select("artifact_id")).select("artifact_id")


@query("SELECT doc_id, greatest(1, length(coalesce(text, '')) // 4) <= 300 - 100 AS fits FROM documents")
def fits_window(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", answers.fits(F.col("text"), F.lit(300), F.lit(100)).alias("fits"))


@query(f"WITH {V.SUMMARIES} SELECT summary_id FROM su")
def checked_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Summaries that are read only if no confidence is out of range; one that is would end the query."""
    c = F.col("confidence")
    return answers.checked(V.summaries(spark, d), c.isNull() | c.between(0, 1), "confidence out of range").select("summary_id")


@query("SELECT DISTINCT record_id, concat_ws('/', agent, model) AS model_id FROM provenance_records")
def model_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provenance_records").select("record_id", parsing.model_id(F.col("agent"), F.col("model")).alias("model_id")).distinct()


_ROLES = [("summarizer", "m1", 8000), ("reviewer", "m2", 16000)]


@query("WITH m(agent, name, context_window) AS (VALUES ('summarizer', 'm1', 8000), ('reviewer', 'm2', 16000)), a AS (SELECT DISTINCT agent FROM provenance_records) SELECT agent, name, coalesce(context_window, 0) AS context_window FROM a LEFT JOIN m USING (agent)")
def role_models(spark: SparkSession, d: str) -> DataFrame:
    models = spark.createDataFrame(_ROLES, "agent string, name string, context_window int")
    return parsing.with_model(table(spark, d, "provenance_records").select("agent").distinct(), models, "agent").select("agent", "name", F.coalesce("context_window", F.lit(0)).alias("context_window"))


@query("WITH f AS (SELECT DISTINCT source_file AS file_name FROM parse_results WHERE source_file IS NOT NULL) SELECT file_name, CASE WHEN ends_with(lower(file_name), '.docx') THEN 'data' ELSE 'style' END AS side FROM f")
def data_style_split(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "parse_results").select(F.col("source_file").alias("file_name")).filter("file_name is not null").distinct()
    return parsing.data_and_style(files, files.filter(F.endswith(F.lower("file_name"), F.lit(".docx"))))


# Texts for and from models


@query("SELECT doc_id, md5(substring(text, 1, 400)) AS digest FROM documents")
def first_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(T.first_tokens(F.col("text"), 100)).alias("digest"))


@query(f"WITH {V.ARTIFACTS}, r AS (SELECT artifact_id, len(table_data) AS n, list_sort(map_keys(table_data[1])) AS head, list_sort(map_keys(table_data[1]))[1] AS h FROM art WHERE len(table_data) > 0) SELECT r.artifact_id, CAST(n AS INT) AS n_rows, coalesce(art.table_data[1][h], '') AS first_cell FROM r JOIN art USING (artifact_id)")
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Tables as rows of cells, turned into rows by header again."""
    rows = V.artifacts(spark, d).filter("size(table_data) > 0").withColumn("head", F.array_sort(F.map_keys(F.get("table_data", 0))))
    cells = F.concat(F.array("head"), F.transform("table_data", lambda r: F.transform("head", lambda h: F.coalesce(F.try_element_at(r, h), F.lit("")))))
    again = T.table_rows(F.col("cells"))
    return rows.withColumn("cells", cells).select("artifact_id", F.size(again).alias("n_rows"), F.try_element_at(F.get(again, 0), F.get("head", 0)).alias("first_cell"))


@query(f"""WITH {V.ARTIFACTS}, im AS (SELECT artifact_id, artifact_type, content, confidence, ['chart', 'map', 'photo', NULL][1 + length(artifact_id || coalesce(content, '')) % 4] AS kind FROM art WHERE artifact_type IN ('image', 'chart', 'map'))
SELECT artifact_id, CASE WHEN content = '' THEN artifact_type WHEN kind IN ('chart', 'map') THEN kind ELSE artifact_type END AS artifact_type, CASE WHEN content = '' THEN '' ELSE '[' || upper(coalesce(kind, 'image')) || ']' || CASE WHEN trim(content, ' ') <> '' THEN chr(10) || content ELSE '' END END AS content,
  round(CASE WHEN content = '' THEN confidence ELSE coalesce(confidence, 0.5) END, 6) AS confidence FROM im""")
def described_images(spark: SparkSession, d: str) -> DataFrame:
    """Images with answers that describe them; an image without content has an answer without JSON."""
    images = V.artifacts(spark, d).filter("artifact_type in ('image', 'chart', 'map')")
    kind = F.get(F.array(F.lit("chart"), F.lit("map"), F.lit("photo"), F.lit(None).cast("string")), F.length(F.concat("artifact_id", "content")) % 4)
    said = F.concat(F.lit("Here it is: "), F.to_json(F.struct(kind.alias("content_type"), F.col("content").alias("description"), "confidence")), F.lit(" done"))
    out = answers.described(images.withColumn("answer", F.when(F.col("content") == "", F.lit("nothing to see")).otherwise(said)))
    return out.select("artifact_id", "artifact_type", "content", F.round("confidence", 6).alias("confidence"))


@query(f"WITH {V.ARTIFACTS}, m AS (SELECT artifact_id, metadata FROM artifacts QUALIFY row_number() OVER (PARTITION BY artifact_id ORDER BY delivered_at DESC NULLS LAST) = 1) SELECT artifact_id, 'done' AS status, substring(content, 1, 20) AS note, coalesce(metadata['is_heading'], '-') AS is_heading FROM art JOIN m USING (artifact_id)")
def stamped_metadata(spark: SparkSession, d: str) -> DataFrame:
    last = state.latest(table(spark, d, "artifacts").select("artifact_id", "delivered_at", F.coalesce("content", F.lit("")).alias("content"), "metadata"), "artifact_id", "delivered_at")
    m = answers.stamped(F.col("metadata"), {"status": F.lit("done"), "note": F.col("content"), "gone": F.lit(None).cast("string")}, 20)
    get = lambda k: F.try_element_at("m", F.lit(k))
    return last.withColumn("m", m).select("artifact_id", get("status").alias("status"), get("note").alias("note"), F.coalesce(get("is_heading"), F.lit("-")).alias("is_heading"))


@query(f"""WITH {V.SUMMARIES} SELECT summary_id, md5('### ' || coalesce(array_to_string(heading_path, ' > '), '') || chr(10) || coalesce(summary, '') || chr(10) || coalesce(array_to_string(list_transform(key_facts, lambda f: '- ' || coalesce(f.fact, '')), chr(10)), '')) AS digest FROM su""")
def summary_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Summaries as blocks of text, compared without the rounded confidence in their first line."""
    return synthesis.summary_block(V.summaries(spark, d)).select("summary_id", F.md5(F.regexp_replace("text", r"^([^\n]*) \(\d+[.,]\d\d\)", "$1")).alias("digest"))


@query("SELECT string_agg('- ' || dimension || ': ' || indicator_name, chr(10) ORDER BY indicator_code) AS text FROM indicators WHERE length(indicator_code) % 2 = 0")
def style_text(spark: SparkSession, d: str) -> DataFrame:
    rules = table(spark, d, "indicators").select(F.col("indicator_code").alias("rule_id"), F.col("dimension").alias("category"), F.col("indicator_name").alias("rule"), F.when(F.length("indicator_code") % 2 == 0, "high").otherwise("low").alias("priority"))
    return answers.style_text(rules)


@query("SELECT string_agg(line, chr(10) ORDER BY line) AS text FROM (SELECT '- ' || dimension || ': ' || indicator_name AS line FROM indicators)")
def risk_text(spark: SparkSession, d: str) -> DataFrame:
    return answers.risk_text(table(spark, d, "indicators").select(F.col("dimension").alias("level"), F.col("indicator_name").alias("description")))


@query(f"WITH {V.SECTIONS}, {ANNOTATIONS} SELECT draft_id, md5(string_agg(line, chr(10) ORDER BY line)) AS digest FROM (SELECT draft_id, '- [' || verdict || '] ' || coalesce(section_id, '') || ': ' || risk_level AS line FROM an WHERE verdict IN ('edit', 'reject')) GROUP BY 1")
def feedback_texts(spark: SparkSession, d: str) -> DataFrame:
    return answers.feedback(_annotations(spark, d).withColumn("reason", F.col("risk_level"))).select("draft_id", F.md5("text").alias("digest"))


@query(f"WITH {V.SUMMARIES} SELECT summary_id, coalesce(summary, '') AS summary, round(coalesce(confidence, 0.5), 6) AS confidence, CAST(coalesce(len(key_facts), 0) AS INT) AS n_facts, coalesce(key_facts[1].category, CASE WHEN len(key_facts) > 0 THEN 'other' END) AS category, CAST(coalesce(len(uncertainties), 0) AS INT) AS n_open FROM su")
def parsed_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Summaries written as an answer with text around its JSON, null fields missing, and parsed again."""
    s = V.summaries(spark, d)
    said = s.select("summary_id", F.concat(F.lit("Sure, here: "), F.to_json(F.struct("summary", "confidence", "uncertainties", F.transform("key_facts", lambda f: F.struct(f["fact"].alias("fact"), f["category"].alias("category"), f["entities"].alias("entities"))).alias("key_facts"))), F.lit("\nHope it helps")).alias("answer"))
    return parsing.summaries(said).select("summary_id", "summary", F.round("confidence", 6).alias("confidence"), F.size("key_facts").alias("n_facts"), F.get("key_facts", 0)["category"].alias("category"), F.size("uncertainties").alias("n_open"))


@query(f"WITH {V.SECTIONS}, h AS (SELECT draft_id, list(heading ORDER BY pos, section_id) FILTER (heading IS NOT NULL) AS hs, count(*) AS n FROM se GROUP BY 1) SELECT draft_id, coalesce(array_to_string(hs, '|'), '') AS section_order, CASE WHEN n % 2 = 0 THEN 'high' ELSE 'medium' END AS priority, 'other' AS category, '' AS tone FROM h")
def parsed_styles(spark: SparkSession, d: str) -> DataFrame:
    se = V.sections(spark, d)
    one = se.groupBy("draft_id").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("heading").isNotNull(), F.struct("pos", "section_id", "heading")))), lambda x: x["heading"]).alias("section_order"), F.count("*").alias("n"))
    rule = F.struct(F.lit("be brief").alias("rule"), F.when(F.col("n") % 2 == 0, "high").alias("priority"))
    said = one.select("draft_id", F.to_json(F.struct("section_order", F.array(rule).alias("rules"))).alias("answer"))
    return parsing.styles(said).select("draft_id", F.array_join("section_order", "|").alias("section_order"), F.get("rules", 0)["priority"].alias("priority"), F.get("rules", 0)["category"].alias("category"), F.col("tone_description").alias("tone"))


def _review_answers(spark: SparkSession, d: str) -> DataFrame:
    """A review of each draft as a model's answer: headings for ids, some verdicts of no known kind, some fields missing."""
    se = V.sections(spark, d).filter("heading is not null")
    said = F.when(F.length("heading") % 3 == 0, "edit").when(F.length("heading") % 3 == 1, "reject").otherwise("Looks fine")
    items = F.struct(F.col("heading").alias("section_heading"), said.alias("verdict"), F.when(F.length("heading") % 2 == 0, "high").alias("risk_level"))
    return se.groupBy("draft_id").agg(F.concat(F.lit("Review: "), F.to_json(F.struct(F.array_sort(F.collect_list(items)).alias("annotations"), F.lit("ok").alias("reviewer_notes")))).alias("answer"))


_REVIEWED = "rv AS (SELECT draft_id, section_id, heading, pos, CASE length(heading) % 3 WHEN 0 THEN 'edit' WHEN 1 THEN 'reject' ELSE 'accept' END AS verdict, CASE WHEN length(heading) % 2 = 0 THEN 'high' ELSE 'low' END AS risk_level FROM se WHERE heading IS NOT NULL)"


@query(f"WITH {V.SECTIONS}, {_REVIEWED}, l AS (SELECT draft_id, heading, arg_max(section_id, (pos, section_id)) AS found FROM rv GROUP BY 1, 2) SELECT draft_id, found AS section_id, verdict, risk_level, true AS fact_check_passed, 0 AS paragraph_index FROM rv JOIN l USING (draft_id, heading)")
def parsed_annotations(spark: SparkSession, d: str) -> DataFrame:
    return parsing.annotations(_review_answers(spark, d), V.sections(spark, d)).select("draft_id", "section_id", "verdict", "risk_level", "fact_check_passed", "paragraph_index")


@query(f"WITH {V.SECTIONS}, {_REVIEWED} SELECT draft_id, CAST(count(*) FILTER (verdict = 'accept') AS INT) AS total_accept, CAST(count(*) FILTER (verdict = 'edit') AS INT) AS total_edit, CAST(count(*) FILTER (verdict = 'reject') AS INT) AS total_reject, CAST(0 AS DOUBLE) AS overall_confidence, 'ok' AS reviewer_notes FROM rv GROUP BY 1")
def parsed_reviews(spark: SparkSession, d: str) -> DataFrame:
    return parsing.reviews(_review_answers(spark, d)).select("draft_id", "total_accept", "total_edit", "total_reject", "overall_confidence", "reviewer_notes")


@query(f"WITH {V.SUMMARIES}, f AS (SELECT summary_id, list_transform(key_facts, lambda f: coalesce(f.fact, '')) AS b FROM su WHERE len(key_facts) > 0) SELECT summary_id, 7 + n AS slide_number, 'T' AS title, CAST(least(len(b), 2) AS INT) AS n_bullets, CAST(len(regexp_extract_all(array_to_string(b, ' '), '[^\\t-\\r \\x{{85}}\\p{{Z}}]+')) AS INT) AS word_count, 'none' AS visual FROM f, (SELECT unnest([0, 1]) AS n)")
def parsed_slides(spark: SparkSession, d: str) -> DataFrame:
    """Facts as bullets of two slides without numbers each, cut to two bullets."""
    s = V.summaries(spark, d).filter("size(key_facts) > 0")
    slide = F.struct(F.lit("T").alias("title"), F.transform("key_facts", lambda f: F.coalesce(f["fact"], F.lit(""))).alias("bullets"))
    said = s.select("summary_id", F.to_json(F.struct(F.array(slide, slide).alias("slides"))).alias("answer"))
    return parsing.slides(said, "summary_id", F.lit(7), 2).select("summary_id", "slide_number", "title", F.size("bullets").alias("n_bullets"), "word_count", F.col("suggested_visual").alias("visual"))


@query(f"""WITH {V.SECTIONS}, s AS (SELECT section_id, coalesce(heading, '') AS heading, 1 + abs(pos) % 3 AS n_slides FROM se) SELECT section_id, CAST(n AS INT) AS n, CASE WHEN n_slides > 1 THEN heading || ' (' || n || '/' || n_slides || ')' ELSE heading END AS title FROM (SELECT *, unnest(generate_series(1, n_slides)) AS n FROM s)""")
def section_slides(spark: SparkSession, d: str) -> DataFrame:
    rows = V.sections(spark, d).withColumn("n_slides", (1 + F.abs("pos") % 3).cast("int"))
    return parsing.packed_slides(rows).select("section_id", "n", "title")


@query(f"WITH {V.SECTIONS}, t AS (SELECT heading, count(*) AS n, avg(pos) AS avg_pos FROM se WHERE heading IS NOT NULL GROUP BY 1 ORDER BY n DESC, avg_pos, heading LIMIT 20) SELECT string_agg(heading, '|' ORDER BY n DESC, avg_pos, heading) AS section_order FROM t")
def learnt_style(spark: SparkSession, d: str) -> DataFrame:
    return parsing.learnt_style(V.sections(spark, d)).select(F.array_join("section_order", "|").alias("section_order"))


@query(f"WITH {V.SECTIONS} SELECT draft_id, CAST(n AS INT) AS heading_no, heading FROM (SELECT draft_id, heading, row_number() OVER (PARTITION BY draft_id ORDER BY pos, section_id) AS n FROM se) WHERE n <= 10")
def first_headings(spark: SparkSession, d: str) -> DataFrame:
    return parsing.first_headings(V.sections(spark, d))


@query(f"WITH {V.SECTIONS}, {ANNOTATIONS} SELECT draft_id, CAST(n AS INT) AS item_no, '## Item ' || n || chr(10) || '- **section_id**: ' || section_id || chr(10) || '- **verdict**: ' || verdict AS text FROM (SELECT *, row_number() OVER (PARTITION BY draft_id ORDER BY section_id) AS n FROM an WHERE verdict <> 'accept')")
def review_items(spark: SparkSession, d: str) -> DataFrame:
    return parsing.review_lines(_annotations(spark, d).filter("verdict <> 'accept'"), "draft_id", ["section_id"], ["section_id", "verdict"])


@query("SELECT event_id, event_type AS text, CAST(floor(value) AS BIGINT) AS tokens_in, CAST(0 AS BIGINT) AS tokens_out, CASE WHEN event_type = 'error' THEN 'failed' END AS error FROM events")
def response_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Responses of a model server built of events: text parts among others, tokens, errors."""
    parts = F.array(F.struct(F.lit("step").alias("type"), F.lit("x").alias("text")), F.struct(F.lit("text").alias("type"), F.col("event_type").alias("text")))
    raw = F.to_json(F.struct(parts.alias("parts"), F.struct(F.floor("value").cast("long").alias("input")).alias("tokens"), F.when(F.col("event_type") == "error", "failed").alias("error")))
    out = table(spark, d, "events").withColumn("e", answers.envelope(raw))
    return out.select("event_id", "e.text", "e.tokens_in", "e.tokens_out", "e.error")


@query(f"WITH {V.SUMMARIES} SELECT summary_id, CASE WHEN len(u) > 2 THEN array_to_string(u[1:2], '|') || '|... and ' || (len(u) - 2) || ' more' ELSE array_to_string(u, '|') END AS items FROM (SELECT summary_id, coalesce(list_transform(key_facts, lambda f: coalesce(f.category, '')), []) AS u FROM su)")
def report_items(spark: SparkSession, d: str) -> DataFrame:
    items = F.transform(F.coalesce("key_facts", F.expr("array()")), lambda f: F.coalesce(f["category"], F.lit("")))
    return V.summaries(spark, d).select("summary_id", F.array_join(quality.first_items(items, 2), "|").alias("items"))


@query("SELECT '| ' || event_type || ' | ' || format('{:,}', count(*)) || ' | ' || format('{:,}', CAST(sum(floor(value)) AS BIGINT)) || ' |' AS line FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def usage_report(spark: SparkSession, d: str) -> DataFrame:
    totals = usage.totals(table(spark, d, "events").filter("event_type is not null").withColumn("v", F.floor("value")), [["event_type"]], ["v"])
    return usage.report(totals, "event_type", ["n_rows", "sum_v"]).select("line")


_SWITCH = "i AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS island FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS streak FROM i), x AS (SELECT *, CASE WHEN event_type = 'error' AND streak % 2 = 0 THEN 1 ELSE 0 END AS hop FROM s)"


@query(f"WITH {_SWITCH} SELECT event_id, CAST(sum(hop) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS model_no FROM x")
def fallback_models(spark: SparkSession, d: str) -> DataFrame:
    """Which model each event would use if two errors in a row switched to the next."""
    e = table(spark, d, "events")
    return usage.model_switches(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") == "purchase", 2).select("event_id", "model_no")


@query(f"WITH {V.SUMMARIES}, {V.CHUNKS} SELECT chunk_id, 'new' AS kind FROM ch WHERE {V.CLEAN.format('chunk_id')} NOT IN (SELECT {V.CLEAN.format('chunk_id')} FROM su WHERE chunk_id IS NOT NULL) UNION ALL SELECT chunk_id, 'stored' FROM su")
def stored_and_new(spark: SparkSession, d: str) -> DataFrame:
    new = state.pending(V.chunks(spark, d), V.summaries(spark, d), "chunk_id").select("chunk_id", F.lit("new").alias("kind"))
    return new.unionByName(V.summaries(spark, d).select("chunk_id", F.lit("stored").alias("kind")))


@query(f"WITH {V.SECTIONS} SELECT section_id, coalesce(heading, '') || ' (' || coalesce(level, 1) || ')' AS name FROM se ORDER BY draft_id, pos LIMIT 1000000000")
def ordered_listing(spark: SparkSession, d: str) -> DataFrame:
    return V.sections(spark, d).orderBy("draft_id", "pos").select("section_id", F.format_string("%s (%d)", F.coalesce("heading", F.lit("")), F.coalesce("level", F.lit(1))).alias("name"))


@query("SELECT count(*) AS n FROM embeddings")
def vector_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").agg(F.count("*").alias("n"))


@query(f"WITH {V.SECTIONS} SELECT draft_id, section_id, CASE WHEN trim(coalesce(content, ''), ' ') = '' OR coalesce(confidence, 0) < 0.7 THEN 'edit' ELSE 'accept' END AS verdict FROM se")
def rule_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews without a model where no reference is unknown."""
    se = V.sections(spark, d)
    return answers.rule_review(se, se.select("section_id").limit(0)).select("draft_id", "section_id", "verdict")
