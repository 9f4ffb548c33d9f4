"""From summaries to sections and slides: grouping, matching of headings, allocation, numbering, texts for models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import exact_mean, word_count
from tessella.tables import clean_id


def section_key(title: Column, path: Column) -> Column:
    """The group of a summary: its section title, else the first heading of its path, else `General`."""
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(blank(title), blank(F.get(path, 0)), F.lit("General"))


def section_groups(summaries: DataFrame) -> DataFrame:
    """By section key: number of summaries, mean confidence (0 for none known), ids in order of sequence, document and id."""
    member = F.struct("sequence_index", "document_id", "summary_id")
    return summaries.groupBy(section_key(F.col("section_title"), F.col("heading_path")).alias("section")).agg(
        F.count("*").alias("n_summaries"), F.coalesce(exact_mean(F.col("confidence")), F.lit(0.0)).alias("avg_confidence"), F.transform(F.array_sort(F.collect_list(member)), lambda m: m["summary_id"]).alias("summary_ids")
    )


def _grams(text: Column, size: int) -> Column:
    """The different runs of `size` characters of a text."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda k: F.substring(text, k, F.lit(size))))


def containing_pairs(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts of `outer` (column a) and `inner` (column b) where a contains b. Empty texts pair with nothing.

    No pair is tried that shares nothing: b is looked for by its rarest run of three characters among those of a, an
    equi-join that is exact at any size, and then tested. Texts b under three characters are looked for by themselves among
    the runs of their own length, and only where there are any.
    """
    a, b = outer.select("a").filter("a <> ''").distinct(), inner.select("b").filter("b <> ''").distinct()
    wide = a.filter("length(a) >= 3").select("a", F.explode(_grams(F.col("a"), 3)).alias("gram"))
    often = wide.groupBy("gram").agg(F.count("*").alias("n"))
    own = b.filter("length(b) >= 3").select("b", F.explode(_grams(F.col("b"), 3)).alias("gram"))
    # A run of b that no a has makes b part of none, so only runs that are there count, and all of them must be.
    rarest = own.join(often, "gram", "left").groupBy("b").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), F.col("gram"))).alias("gram"), F.min(F.coalesce("n", F.lit(0))).alias("least")).filter("least > 0")
    long = wide.join(rarest, "gram").filter(F.contains(F.col("a"), F.col("b"))).select("a", "b")
    short = b.filter("length(b) < 3")
    runs = F.flatten(F.array(*(F.when(F.length("a") >= n, _grams(F.col("a"), n)).otherwise(F.array().cast("array<string>")) for n in (1, 2))))
    return long.unionByName(a.select("a", F.explode(runs).alias("b")).join(short, "b").select("a", "b"))


def contains_match(targets: DataFrame, groups: DataFrame) -> DataFrame:
    """For each target the first group (by `ord`) whose name contains it or is contained in it, in any letter case.

    `targets` has target, `groups` has section and ord.
    """
    t = targets.select("target", F.lower("target").alias("t")).distinct()
    g = groups.select("section", "ord", F.lower("section").alias("g"))
    t_names, g_names = t.select(F.col("t").alias("a")), g.select(F.col("g").alias("a"))
    in_target = containing_pairs(t_names, g.select(F.col("g").alias("b"))).select(F.col("a").alias("t"), F.col("b").alias("g"))
    in_group = containing_pairs(g_names, t.select(F.col("t").alias("b"))).select(F.col("b").alias("t"), F.col("a").alias("g"))
    pairs = in_target.unionByName(in_group).distinct()
    return t.join(pairs, "t").join(g, "g").groupBy("target").agg(F.min_by("section", F.struct("ord", "section")).alias("section"))


def match_sections(targets: DataFrame, groups: DataFrame) -> DataFrame:
    """target, section, how: the group of the same name (`exact`), else the first by containment (`contains`), else null (`none`)."""
    exact = targets.select("target").distinct().join(groups.select("section"), F.col("target") == F.col("section"), "left")
    rest = exact.filter("section is null").select("target")
    loose = contains_match(rest, groups)
    both = exact.filter("section is not null").select("target", "section", F.lit("exact").alias("how"))
    return both.unionByName(rest.join(loose, "target", "left").select("target", "section", F.when(F.col("section").isNotNull(), "contains").otherwise("none").alias("how")))


def unused_summaries(summaries: DataFrame, sections: DataFrame) -> DataFrame:
    """Summaries that no section names among its source_summary_ids."""
    used = sections.select(F.explode("source_summary_ids").alias("item")).select(clean_id(F.col("item")).alias("used_id")).filter("used_id is not null").distinct()
    return summaries.join(used, clean_id(F.col("summary_id")) == F.col("used_id"), "left_anti")


def heading_ids(names: DataFrame, sections: DataFrame) -> DataFrame:
    """`name` with section_id: the id of the last section (by pos) with that heading, else the name itself."""
    last = sections.groupBy("heading").agg(F.max_by("section_id", F.struct("pos", "section_id")).alias("found"))
    return names.join(last, F.col("name") == F.col("heading"), "left").select("name", F.coalesce("found", "name").alias("section_id"))


def carried_lineage(new: DataFrame, old: DataFrame) -> DataFrame:
    """Headings of a rewritten draft with confidence and source chunks of the old section of the same heading (by pos the last)."""
    last = old.groupBy("heading").agg(F.max_by(F.struct("source_chunk_ids", "confidence"), F.struct("pos", "section_id")).alias("o"))
    return new.join(last, "heading", "left").select(new["*"], F.coalesce("o.source_chunk_ids", F.array().cast("array<string>")).alias("source_chunk_ids"), F.coalesce("o.confidence", F.lit(0.0)).alias("confidence"))


def allocate(sections: DataFrame, draft: str = "draft_id", least: int = 80, most: int = 100, reserved: int = 2) -> DataFrame:
    """Adds n_slides: the slides of a draft (most - reserved) shared by words, at least 1 each, rounded half to even.

    If the sum is beyond the range (most or least, less the reserved), all are scaled towards it once and rounded again,
    so it may still miss. Drafts without words share evenly, rounded down.
    """
    d = Window.partitionBy(draft)
    words = word_count(F.col("content"))
    room, floor = float(most - reserved), float(least - reserved)
    first = F.greatest(F.lit(1.0), F.bround(F.col("n_words") / F.col("all_words") * room))
    total = F.sum("first").over(d)
    factor = F.when(total > room, room / total).when(total < floor, floor / F.greatest(total, F.lit(1.0))).otherwise(1.0)
    return (
        sections.withColumn("n_words", words)
        .withColumn("all_words", F.sum("n_words").over(d))
        .withColumn("first", F.when(F.col("all_words") > 0, first))
        .withColumn("n_slides", F.when(F.col("all_words") > 0, F.greatest(F.lit(1.0), F.bround(F.col("first") * factor))).otherwise(F.floor(F.lit(room) / F.count("*").over(d))).cast("int"))
        .drop("all_words", "first")
    )


def numbered_slides(allocated: DataFrame, draft: str = "draft_id") -> DataFrame:
    """A row for each slide of a draft, numbered from 1: title, contents, then the slides of its sections in order of pos."""
    front = allocated.select(draft).distinct().select(draft, F.explode(F.array(F.struct(F.lit(-2).alias("rank"), F.lit("title").alias("heading")), F.struct(F.lit(-1).alias("rank"), F.lit("contents").alias("heading")))).alias("x")).select(draft, F.col("x.rank").alias("pos"), "x.heading", F.lit("").alias("section_id"), F.lit(1).alias("n"))
    body = allocated.select(draft, F.col("pos"), "heading", "section_id", F.explode(F.sequence(F.lit(1), F.greatest("n_slides", F.lit(1)))).alias("n"))
    order = Window.partitionBy(draft).orderBy("pos", "section_id", "n")
    return front.unionByName(body).withColumn("slide_number", F.row_number().over(order)).select(draft, "slide_number", "section_id", "heading", "n")


def prefix_within(df: DataFrame, by: list[str], order: list[str], size: Column, budget: int) -> DataFrame:
    """The first rows of each group while their sizes add up to at most the budget."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(size).over(w)).filter(F.col("running") <= budget)


def first_facts(summaries: DataFrame, per_summary: int = 3, limit: int | None = 200) -> DataFrame:
    """The first facts of each summary, in order of document, sequence, id and place; `limit` in all, null for no limit."""
    rows = summaries.select("document_id", "sequence_index", "summary_id", F.posexplode(F.slice("key_facts", 1, per_summary)).alias("fact_no", "f")).select("document_id", "sequence_index", "summary_id", "fact_no", "f.fact", "f.category")
    return rows if limit is None else rows.orderBy("document_id", "sequence_index", "summary_id", "fact_no").limit(limit)


def draft_text(sections: DataFrame, draft: str = "draft_id") -> DataFrame:
    """The Markdown of each draft: for each section by pos a heading of its level and its content."""
    block = F.concat(F.repeat(F.lit("#"), F.greatest(F.coalesce("level", F.lit(1)), F.lit(1))), F.lit(" "), F.coalesce("heading", F.lit("")), F.lit("\n\n"), F.coalesce("content", F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("pos", "section_id", block.alias("t"))))
    return sections.groupBy(draft).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n\n").alias("text"))


def summary_block(summaries: DataFrame) -> DataFrame:
    """A block of Markdown for each summary: summary_id, text."""
    return summaries.select("summary_id", F.format_string("### %s (%.2f)\n%s\n%s", F.array_join(F.coalesce("heading_path", F.array().cast("array<string>")), " > "), F.coalesce("confidence", F.lit(0.0)), F.coalesce("summary", F.lit("")), F.array_join(F.transform(F.coalesce("key_facts", F.expr("array()")), lambda f: F.concat(F.lit("- "), F.coalesce(f["fact"], F.lit("")))), "\n")).alias("text"))


def chunk_prompt(chunks: DataFrame) -> DataFrame:
    """The prompt for each chunk: file, path, what it holds, content."""
    return chunks.select(
        "chunk_id",
        F.concat_ws(
            "\n",
            F.concat(F.lit("Source: "), F.coalesce("source_file", F.lit(""))),
            F.concat(F.lit("Section: "), F.array_join("heading_path", " > ")),
            F.when(F.col("contains_tables"), F.lit("It holds tables.")),
            F.when(F.col("contains_images"), F.lit("It holds descriptions of images.")),
            F.lit(""),
            F.coalesce("content", F.lit("")),
        ).alias("prompt"),
    )
