"""Sections and heading paths of documents that are ordered artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.plans.fold import ordered_fold

#: Title of what comes before the first section.
OPENING = "Introduction"


def with_sections(artifacts: DataFrame, document: str = "document_id", pos: str = "pos", max_level: int = 2) -> DataFrame:
    """Adds section_no (from 0) and section_title.

    A heading of a level up to max_level begins a section unless it is the first artifact; the first section is called
    OPENING. A heading without a level counts as level 0. Needs is_heading, heading_level and content. One window.
    """
    order = Window.partitionBy(document).orderBy(pos)
    begins = F.coalesce("is_heading", F.lit(False)) & (F.coalesce("heading_level", F.lit(0)) <= max_level) & (F.row_number().over(order) > 1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        artifacts.withColumn("_begins", begins)
        .withColumn("section_no", F.sum(F.col("_begins").cast("int")).over(upto).cast("int"))
        .withColumn("section_title", F.coalesce(F.last(F.when(F.col("_begins"), F.coalesce("content", F.lit(""))), ignorenulls=True).over(upto), F.lit(OPENING)))
        .drop("_begins")
    )


def heading_stack(headings: DataFrame, document: str = "document_id", pos: str = "pos") -> DataFrame:
    """Adds `path`, the headings that each heading stands under, itself last: deeper or equally deep entries of the stack
    are taken off until it is shorter than the level. Levels that are skipped leave no gap."""

    def step(stack, row):
        level = max(row["heading_level"] or 1, 1)
        stack = [*stack[: level - 1], row["content"] or ""]
        return stack, {"path": stack}

    return ordered_fold(headings, [document], [pos], list, step, "path array<string>", ["heading_level", "content"])


def section_paths(artifacts: DataFrame, document: str = "document_id", pos: str = "pos") -> DataFrame:
    """Adds `heading_path` to artifacts with sections: it starts with the section's title, is cut to a heading's level,
    and the heading is put in its place or added."""

    def step(path, row):
        path = path or [row["section_title"]]
        if row["is_heading"]:
            level = row["heading_level"] if row["heading_level"] is not None else 1
            path = path[: max(level, 0)]
            path = [*path, row["_heading"]] if len(path) < level else [*path[: level - 1], row["_heading"], *path[level:]]
        return path, {"heading_path": path}

    # Only headings and titles of sections that begin reach Python; other texts stay in Arrow.
    named = artifacts.withColumn("_heading", F.when(F.col("is_heading"), F.coalesce("content", F.lit(""))))
    return ordered_fold(named, [document, "section_no"], [pos], list, step, "heading_path array<string>", ["section_title", "is_heading", "heading_level", "_heading"]).drop("_heading")


def markdown_sections(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Sections of Markdown texts: key, section_no, heading, level, content.

    A line whose first character is # begins a section at any depth. What stands before the first heading joins the
    first section; headings without any line after them, and sections without text, are left out.
    """
    lines = texts.select(F.col(key), F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line", F.btrim("line"))
    order = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("is_heading", F.startswith("line", F.lit("#"))).withColumn("n", F.sum(F.col("is_heading").cast("int")).over(order)).withColumn("section_no", F.greatest(F.col("n"), F.lit(1)))
    body = F.array_sort(F.collect_list(F.when(~F.col("is_heading"), F.struct("line_no", "line"))))
    return (
        marked.groupBy(key, "section_no")
        .agg(F.max(F.when(F.col("is_heading"), F.col("line"))).alias("raw"), body.alias("body"))
        .filter("raw is not null and size(body) > 0")
        .select(
            key,
            F.col("section_no").cast("int").alias("section_no"),
            F.btrim(F.regexp_replace("raw", "^#+", "")).alias("heading"),
            F.length(F.regexp_extract("raw", "^(#+)", 1)).alias("level"),
            F.btrim(F.array_join(F.transform("body", lambda x: x["line"]), "\n"), F.lit(" \n")).alias("content"),
        )
    )
