"""What goes to and comes from models as columns: descriptions of images, metadata, styles, risks, envelopes, reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import json_between_braces, token_estimate

DESCRIPTION = "content_type string, description string, data_summary string, geographic_info string, confidence double"
#: Which artifact type an image becomes by the type of its content; others stay.
IMAGE_TYPES = {"chart": "chart", "graph": "chart", "map": "map", "table": "table"}


def described(images: DataFrame, answer: str = "answer") -> DataFrame:
    """Images with the text and type of their description; original_type keeps the type before.

    The text is a tag of the content type and a line for each part that is not blank. An answer without JSON leaves the
    row as it is; a missing confidence is 0.5.
    """
    j = F.from_json(json_between_braces(F.col(answer)), DESCRIPTION)
    part = lambda name, label: F.when(F.coalesce(F.btrim(F.col(f"_d.{name}")), F.lit("")) != "", F.concat(F.lit(label), F.col(f"_d.{name}")))
    text = F.concat_ws("\n", F.concat(F.lit("["), F.upper(F.coalesce("_d.content_type", F.lit("image"))), F.lit("]")), part("description", ""), part("data_summary", "Data: "), part("geographic_info", "Places: "))
    kinds = F.create_map(*(F.lit(x) for kv in IMAGE_TYPES.items() for x in kv))
    known = F.col("_d").isNotNull()
    return (
        images.withColumn("_d", j)
        .withColumn("original_type", F.col("artifact_type"))
        .withColumn("content", F.when(known, text).otherwise(F.col("content")))
        .withColumn("artifact_type", F.when(known, F.coalesce(F.try_element_at(kinds, F.lower("_d.content_type")), F.col("artifact_type"))).otherwise(F.col("artifact_type")))
        .withColumn("confidence", F.when(known, F.coalesce("_d.confidence", F.lit(0.5))).otherwise(F.col("confidence")))
        .drop("_d")
    )


def stamped(metadata: Column, values: dict[str, Column], limit: int = 300) -> Column:
    """Metadata with keys set; a key with a null value is taken out, a value is cut to `limit` characters."""
    new = F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.substring(v.cast("string"), 1, limit))))
    kept = F.map_filter(F.coalesce(metadata, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*values))
    return F.map_concat(kept, F.map_filter(new, lambda k, v: v.isNotNull()))


def image_targets(artifacts: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Images that have data, only those of `ids` (artifact_id) if given."""
    rows = artifacts.filter((F.col("artifact_type") == "image") & F.col("image").isNotNull())
    return rows if ids is None else rows.join(ids.select("artifact_id").distinct(), "artifact_id", "left_semi")


def fits(text: Column, window: Column, reserve: Column) -> Column:
    """Whether a text leaves `reserve` tokens of a model's window free."""
    return token_estimate(text) <= window - reserve


def checked(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """`df`; reading it fails if a row does not meet the condition."""
    return df.filter(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def style_text(rules: DataFrame) -> DataFrame:
    """Rules of high priority as one text: a line each, in order of rule_id."""
    lines = F.array_sort(F.collect_list(F.when(F.col("priority") == "high", F.struct("rule_id", F.concat(F.lit("- "), F.col("category"), F.lit(": "), F.col("rule")).alias("line")))))
    return rules.agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))


def risk_text(risks: DataFrame) -> DataFrame:
    """Risks as one text: a line each in order of level and description; a sentence if there are none."""
    lines = F.array_sort(F.collect_list(F.concat(F.lit("- "), F.coalesce("level", F.lit("?")), F.lit(": "), F.coalesce("description", F.lit("")))))
    return risks.agg(F.coalesce(F.nullif(F.array_join(lines, "\n"), F.lit("")), F.lit("No risks were noted.")).alias("text"))


def envelope(raw: Column) -> Column:
    """Parts of a model server's response in JSON: text (parts of type text joined), structured, tokens in and out, error."""
    kind = "struct<parts: array<struct<type: string, text: string>>, structured: string, tokens: struct<input: long, output: long>, error: string>"
    r = F.from_json(raw, kind)
    texts = F.transform(F.filter(r["parts"], lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit("")))
    return F.struct(
        F.coalesce(F.array_join(texts, "\n"), F.lit("")).alias("text"),
        r["structured"].alias("structured"),
        F.coalesce(r["tokens"]["input"], F.lit(0)).alias("tokens_in"),
        F.coalesce(r["tokens"]["output"], F.lit(0)).alias("tokens_out"),
        F.when(r.isNull(), F.lit("no json")).otherwise(r["error"]).alias("error"),
    )


def feedback(annotations: DataFrame) -> DataFrame:
    """What a draft is to be changed for: one text by draft of its edit and reject annotations; drafts without any are left out."""
    line = F.format_string("- [%s] %s: %s", F.col("verdict"), F.coalesce("section_id", F.lit("")), F.coalesce("reason", F.lit("")))
    wanted = annotations.filter(F.col("verdict").isin("edit", "reject"))
    return wanted.groupBy("draft_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))


def rule_review(sections: DataFrame, unknown: DataFrame, least: float = 0.7) -> DataFrame:
    """A review without a model: a section with unknown references is rejected, one of low confidence or without text is edited.

    Columns draft_id, section_id, verdict, risk_level, reason. `unknown` has section_id.
    """
    bad = unknown.groupBy("section_id").agg(F.count("*").alias("n_unknown"))
    c = F.coalesce("confidence", F.lit(0.0))
    blank = F.btrim(F.coalesce("content", F.lit(""))) == ""
    return sections.join(bad, "section_id", "left").select(
        "draft_id",
        "section_id",
        F.when(F.col("n_unknown") > 0, "reject").when(blank | (c < least), "edit").otherwise("accept").alias("verdict"),
        F.when(F.col("n_unknown") > 2, "high").otherwise("low").alias("risk_level"),
        F.when(F.col("n_unknown") > 0, F.format_string("%d unknown references", F.col("n_unknown"))).when(blank, "no text").when(c < least, F.format_string("confidence %.3f", c)).alias("reason"),
    )
