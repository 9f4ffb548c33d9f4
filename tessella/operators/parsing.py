"""Answers of models as rows: JSON is found in the text, and every missing part has a stated default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import json_between_braces, word_count

FACT = "struct<fact: string, category: string, entities: array<string>>"
NUMBER = "struct<label: string, value: double, unit: string, context: string>"
SUMMARY = f"summary string, key_facts array<{FACT}>, numeric_table array<{NUMBER}>, uncertainties array<string>, confidence double"
RULE = "struct<category: string, rule: string, examples_do: array<string>, examples_dont: array<string>, priority: string>"
STYLE = f"section_order array<string>, preferred_headings array<string>, rules array<{RULE}>, bullet_density string, allowed_abbreviations array<string>, numeric_formatting string, citation_style string, tone_description string, target_reader string, reviewer_checklist array<string>"
ANNOTATION = "struct<section_heading: string, paragraph_index: int, verdict: string, reason: string, suggested_replacement: string, fact_check_passed: boolean, numeric_check_passed: boolean, tone_check_passed: boolean, risk_level: string>"
RISK = "struct<level: string, description: string, affected_sections: array<string>>"
REVIEW = f"annotations array<{ANNOTATION}>, risk_register array<{RISK}>, overall_confidence double, reviewer_notes string"
SLIDE = "struct<slide_number: int, title: string, bullets: array<string>, suggested_visual: string, visual_description: string, source_references: array<string>, speaker_notes: string>"
SLIDES = f"slides array<{SLIDE}>"


def _json(answer: str, schema: str) -> Column:
    return F.from_json(json_between_braces(F.col(answer)), schema)


def _texts() -> Column:
    return F.array().cast("array<string>")


def summaries(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Adds summary, key_facts, numeric_table, uncertainties and confidence.

    Missing texts are empty, missing lists too; a fact without category is `other`, a number without value 0, a missing
    confidence 0.5. An answer without JSON is like an empty object.
    """
    j = answers.withColumn("_j", _json(answer, SUMMARY))
    facts = F.transform(F.coalesce("_j.key_facts", F.array().cast(f"array<{FACT}>")), lambda x: F.struct(F.coalesce(x["fact"], F.lit("")).alias("fact"), F.coalesce(x["category"], F.lit("other")).alias("category"), F.coalesce(x["entities"], _texts()).alias("entities")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    numeric = F.transform(F.coalesce("_j.numeric_table", F.array().cast(f"array<{NUMBER}>")), lambda x: F.struct(blank(x["label"]).alias("label"), F.coalesce(x["value"], F.lit(0.0)).alias("value"), blank(x["unit"]).alias("unit"), blank(x["context"]).alias("context")))
    return j.withColumns({"summary": blank(F.col("_j.summary")), "key_facts": facts, "numeric_table": numeric, "uncertainties": F.coalesce("_j.uncertainties", _texts()), "confidence": F.coalesce("_j.confidence", F.lit(0.5))}).drop("_j")


def styles(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Adds the parts of a style guide: missing texts and lists are empty; a rule's category is `other` and its priority
    `medium` where they are missing."""
    j = answers.withColumn("_j", _json(answer, STYLE))
    rules = F.transform(
        F.coalesce("_j.rules", F.array().cast(f"array<{RULE}>")),
        lambda r: F.struct(F.coalesce(r["category"], F.lit("other")).alias("category"), F.coalesce(r["rule"], F.lit("")).alias("rule"), F.coalesce(r["examples_do"], _texts()).alias("examples_do"), F.coalesce(r["examples_dont"], _texts()).alias("examples_dont"), F.coalesce(r["priority"], F.lit("medium")).alias("priority")),
    )
    lists = ("section_order", "preferred_headings", "allowed_abbreviations", "reviewer_checklist")
    texts = ("bullet_density", "numeric_formatting", "citation_style", "tone_description", "target_reader")
    return j.withColumns({"rules": rules, **{c: F.coalesce(f"_j.{c}", _texts()) for c in lists}, **{c: F.coalesce(f"_j.{c}", F.lit("")) for c in texts}}).drop("_j")


def verdict(said: Column) -> Column:
    """accept, edit or reject; anything else, null too, is accept."""
    return F.when(said.isin("edit", "reject"), said).otherwise("accept")


def annotations(answers: DataFrame, sections: DataFrame, draft: str = "draft_id", answer: str = "answer") -> DataFrame:
    """A row for each annotation of a review: the draft, section_id, verdict, reason and checks, with defaults.

    A heading becomes the id of the draft's last section of that heading, by pos, and stays itself where there is none.
    Checks that are missing passed; a missing risk is low.
    """
    rows = answers.select(draft, F.posexplode(_json(answer, REVIEW)["annotations"]).alias("annotation_no", "a")).withColumn("heading", F.coalesce("a.section_heading", F.lit("")))
    ids = sections.filter("heading is not null").groupBy(draft, "heading").agg(F.max_by("section_id", F.struct("pos", "section_id")).alias("found"))
    passed = lambda c: F.coalesce(f"a.{c}", F.lit(True)).alias(c)
    return rows.join(ids, [draft, "heading"], "left").select(
        draft, "annotation_no", F.coalesce("found", "heading").alias("section_id"), F.coalesce("a.paragraph_index", F.lit(0)).alias("paragraph_index"), verdict(F.col("a.verdict")).alias("verdict"), F.coalesce("a.reason", F.lit("")).alias("reason"),
        F.coalesce("a.suggested_replacement", F.lit("")).alias("suggested_replacement"), passed("fact_check_passed"), passed("numeric_check_passed"), passed("tone_check_passed"), F.coalesce("a.risk_level", F.lit("low")).alias("risk_level"),
    )


def reviews(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Adds what a review says as a whole: counts of verdicts, risk_register, overall_confidence (0 if missing), notes."""
    j = answers.withColumn("_j", _json(answer, REVIEW))
    said = F.transform(F.coalesce("_j.annotations", F.array().cast(f"array<{ANNOTATION}>")), lambda a: verdict(a["verdict"]))
    count = lambda k: F.size(F.filter(said, lambda v: v == k))
    return j.withColumns({**{f"total_{k}": count(k) for k in ("accept", "edit", "reject")}, "risk_register": F.coalesce("_j.risk_register", F.array().cast(f"array<{RISK}>")), "overall_confidence": F.coalesce("_j.overall_confidence", F.lit(0.0)), "reviewer_notes": F.coalesce("_j.reviewer_notes", F.lit(""))}).drop("_j")


def slides(answers: DataFrame, key: str, start: Column, bullets: int = 5, answer: str = "answer") -> DataFrame:
    """A row for each slide of an answer: key, slide_number, title, bullets (the first few), what to show, word_count.

    A missing number goes on from `start`; the words are those of all bullets, also of those that are left out.
    """
    rows = answers.select(key, start.alias("_start"), F.posexplode(_json(answer, SLIDES)["slides"]).alias("n", "s"))
    all_bullets = F.coalesce("s.bullets", _texts())
    words = F.aggregate(F.transform(all_bullets, word_count), F.lit(0), lambda a, x: a + x)
    texts = lambda c, default="": F.coalesce(f"s.{c}", F.lit(default)).alias(c)
    return rows.select(key, F.coalesce("s.slide_number", F.col("_start") + F.col("n")).alias("slide_number"), texts("title"), F.slice(all_bullets, 1, bullets).alias("bullets"), texts("suggested_visual", "none"), texts("visual_description"), F.coalesce("s.source_references", _texts()).alias("source_references"), texts("speaker_notes"), words.alias("word_count"))


def packed_slides(allocated: DataFrame, bullets: int = 5) -> DataFrame:
    """Slides of sections without a model: section_id, n, title, bullets.

    `allocated` has section_id, heading, content and n_slides. Sentences are dealt in order to the slides of a section, as
    evenly as they go, and each slide shows its first few; a section without text has slides without bullets.
    """
    said = F.filter(F.split(F.coalesce("content", F.lit("")), r"(?<=[.!?])\s+|\n+"), lambda s: F.btrim(s) != "")
    rows = allocated.select("section_id", "heading", said.alias("said"), F.greatest("n_slides", F.lit(1)).alias("n_slides")).withColumn("each", F.ceil(F.size("said") / F.col("n_slides")).cast("int"))
    dealt = rows.select("section_id", "heading", "said", "each", "n_slides", F.explode(F.sequence(F.lit(1), F.col("n_slides"))).alias("n"))
    own = F.slice("said", (F.col("n") - 1) * F.col("each") + 1, F.least(F.col("each"), F.lit(bullets)))
    title = F.when(F.col("n_slides") > 1, F.format_string("%s (%d/%d)", F.coalesce("heading", F.lit("")), F.col("n"), F.col("n_slides"))).otherwise(F.coalesce("heading", F.lit("")))
    return dealt.select("section_id", "n", title.alias("title"), F.transform(own, lambda s: F.btrim(s)).alias("bullets"))


def learnt_style(sections: DataFrame) -> DataFrame:
    """A style guide without a model, one row: section_order (headings by how often and how early they stand), bullet_share
    (lines that are list items) and mean words of a section."""
    lines = F.filter(F.split(F.coalesce("content", F.lit("")), "\n"), lambda x: F.btrim(x) != "")
    listed = F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"^\s*[-*•]")))
    totals = sections.agg(F.coalesce(F.try_divide(F.sum(F.size(listed)), F.sum(F.size(lines))), F.lit(0.0)).alias("bullet_share"), F.coalesce(F.avg(word_count(F.col("content"))), F.lit(0.0)).alias("mean_words"))
    top = sections.filter("heading is not null").groupBy("heading").agg(F.count("*").alias("n"), F.avg("pos").alias("at")).orderBy(F.col("n").desc(), "at", "heading").limit(20)
    order = top.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "at", "heading"))), lambda x: x["heading"]).alias("section_order"))
    return order.crossJoin(totals)


def first_headings(sections: DataFrame, draft: str = "draft_id", n: int = 10) -> DataFrame:
    """The first headings of each draft in order of pos."""
    order = Window.partitionBy(draft).orderBy("pos", "section_id")
    return sections.withColumn("heading_no", F.row_number().over(order)).filter(F.col("heading_no") <= n).select(draft, "heading_no", "heading")


def review_lines(items: DataFrame, by: str, order: list[str], fields: list[str]) -> DataFrame:
    """Items for people as a block of Markdown each: the file `by`, item_no in it, text. Null values are left blank."""
    number = Window.partitionBy(by).orderBy(*order)
    said = F.concat_ws("\n", *(F.format_string(f"- **{f}**: %s", F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in fields))
    return items.withColumn("item_no", F.row_number().over(number)).select(by, "item_no", F.concat(F.lit("## Item "), F.col("item_no").cast("string"), F.lit("\n"), said).alias("text"))


def audit_rows(df: DataFrame, stage: str, agent: Column, action: str, output_id: Column, input_ids: Column, tokens_in: Column, tokens_out: Column, confidence: Column | None = None) -> DataFrame:
    """Rows of the audit log of a stage, one for each row of `df`; missing lists are empty, missing counts 0."""
    return df.select(
        F.lit(stage).alias("stage"), agent.alias("agent"), F.lit(action).alias("action"), F.coalesce(input_ids, _texts()).alias("input_ids"), F.when(output_id.isNotNull(), F.array(output_id)).otherwise(_texts()).alias("output_ids"),
        F.coalesce(tokens_in, F.lit(0)).cast("long").alias("tokens_input"), F.coalesce(tokens_out, F.lit(0)).cast("long").alias("tokens_output"), (F.lit(None).cast("double") if confidence is None else confidence).alias("confidence"),
    )


def model_id(provider: Column, model: Column) -> Column:
    """`provider/model`."""
    return F.concat_ws("/", provider, model)


def with_model(rows: DataFrame, models: DataFrame, role: str = "role") -> DataFrame:
    """Rows with the columns of their role's model; null for roles without one. `models` is a dimension: AQE sends it out if it is small."""
    return rows.join(models, role, "left")


def data_and_style(files: DataFrame, data: DataFrame, fallback: int = 2) -> DataFrame:
    """Files with `side`: data for names in `data` (file_name), style for the rest; if there is no rest, the first few by
    name are style too, as a second row."""
    named = files.join(data.select("file_name").distinct().withColumn("_data", F.lit(True)), "file_name", "left").withColumn("side", F.when(F.col("_data"), "data").otherwise("style")).drop("_data")
    rest = named.agg(F.count_if(F.col("side") == "style").alias("n_style"))
    first = named.orderBy("file_name").limit(fallback).crossJoin(rest).filter("n_style = 0").withColumn("side", F.lit("style")).drop("n_style")
    return named.unionByName(first)
