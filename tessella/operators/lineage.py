"""Which sources a draft section comes from, and whether its references hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import exact_mean
from tessella.tables import clean_id


def section_references(sections: DataFrame, keys: str = "source_chunk_ids") -> DataFrame:
    """Long form of the keys that sections name: section_id, ref_no (place in the list), chunk_id. Repeated keys stay."""
    return sections.select("section_id", F.posexplode(keys).alias("ref_no", "item")).select("section_id", "ref_no", clean_id(F.col("item")).alias("chunk_id")).filter("chunk_id is not null")


def last_summary(summaries: DataFrame) -> DataFrame:
    """One summary for each chunk: the last by summarized_at, of equals the greatest id."""
    slim = F.struct("summarized_at", "summary_id", "provenance_id", "source_file", "confidence")
    return summaries.filter("chunk_id is not null").groupBy(clean_id(F.col("chunk_id")).alias("chunk_id")).agg(F.max(slim).alias("s")).select("chunk_id", "s.*")


def lineage_chain(sections: DataFrame, summaries: DataFrame) -> DataFrame:
    """A row for each reference of a section with the summary of its chunk, or a placeholder `missing:<chunk>`.

    Columns section_id, ref_no, chunk_id, provenance_id, source_file, is_known. One join on the chunk; AQE splits hot chunks.
    """
    joined = section_references(sections).join(last_summary(summaries), "chunk_id", "left")
    known = F.col("summary_id").isNotNull()
    return joined.select("section_id", "ref_no", "chunk_id", F.when(known, F.col("provenance_id")).otherwise(F.concat(F.lit("missing:"), "chunk_id")).alias("provenance_id"), "source_file", known.alias("is_known"))


def section_sources(sections: DataFrame, chunks: DataFrame) -> DataFrame:
    """The source files of each section's chunks in order of name, and how many locations they have; empty for none."""
    files = chunks.select(clean_id(F.col("chunk_id")).alias("chunk_id"), "source_file", F.greatest(F.size("source_locations"), F.lit(0)).alias("n")).groupBy("chunk_id").agg(F.max("source_file").alias("source_file"), F.max("n").alias("n"))
    found = section_references(sections).join(files, "chunk_id", "left").groupBy("section_id").agg(F.array_sort(F.collect_set("source_file")).alias("source_files"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_locations"))
    every = sections.select("section_id").distinct()
    return every.join(found, "section_id", "left").select("section_id", F.coalesce("source_files", F.array().cast("array<string>")).alias("source_files"), F.coalesce("n_locations", F.lit(0)).alias("n_locations"))


def unknown_references(sections: DataFrame, summaries: DataFrame) -> DataFrame:
    """References to chunks without any summary; repeated references stay."""
    known = summaries.select(clean_id(F.col("chunk_id")).alias("chunk_id")).distinct()
    return section_references(sections).join(known, "chunk_id", "left_anti")


def reference_report(sections: DataFrame, summaries: DataFrame) -> DataFrame:
    """One row: sections, sections with and without sources, coverage (0 for no sections), unknown references, validity.

    References to unknown chunks are counted but do not make a draft invalid; sections without any do.
    """
    n_refs = F.size(F.filter(F.coalesce("source_chunk_ids", F.array().cast("array<string>")), lambda x: clean_id(x).isNotNull()))
    counts = sections.select("section_id", n_refs.alias("n")).agg(F.count("*").alias("n_sections"), F.count_if(F.col("n") > 0).alias("n_with"), F.count_if(F.col("n") == 0).alias("n_without"))
    orphans = unknown_references(sections, summaries).agg(F.count("*").alias("n_unknown"))
    return counts.crossJoin(orphans).withColumn("coverage", F.coalesce(F.try_divide("n_with", "n_sections"), F.lit(0.0))).withColumn("is_valid", F.col("n_without") == 0)


def inverted_index(sections: DataFrame) -> DataFrame:
    """For each chunk how many references name it, from how many sections, and the first section."""
    return section_references(sections).groupBy("chunk_id").agg(F.count("*").alias("n_references"), F.countDistinct("section_id").alias("n_sections"), F.min("section_id").alias("first_section"))


def file_stats(summaries: DataFrame, numeric: DataFrame) -> DataFrame:
    """By source file: summaries, mean confidence, key facts, numeric entries, uncertainties."""
    numbers = numeric.filter("source_file is not null").groupBy("source_file").agg(F.count("*").alias("n_numeric"))
    by_file = summaries.groupBy("source_file").agg(
        F.count("*").alias("n_chunks"),
        exact_mean(F.col("confidence")).alias("avg_confidence"),
        F.sum(F.greatest(F.size("key_facts"), F.lit(0))).alias("n_facts"),
        F.sum(F.greatest(F.size("uncertainties"), F.lit(0))).alias("n_uncertainties"),
    )
    return by_file.join(numbers, "source_file", "left").withColumn("n_numeric", F.coalesce("n_numeric", F.lit(0)))


def section_report(sections: DataFrame, chain: DataFrame) -> DataFrame:
    """A Markdown line for each section: heading, references, unknown ones, source files in order of name."""
    by = chain.groupBy("section_id").agg(F.count("*").alias("n"), F.count_if(~F.col("is_known")).alias("n_unknown"), F.array_join(F.array_sort(F.collect_set("source_file")), ", ").alias("files"))
    return sections.select("section_id", "heading").join(by, "section_id", "left").select(
        "section_id",
        F.format_string("- **%s**: %d references, %d unknown, files: %s", F.coalesce("heading", F.lit("")), F.coalesce("n", F.lit(0)), F.coalesce("n_unknown", F.lit(0)), F.coalesce(F.nullif("files", F.lit("")), F.lit("none"))).alias("line"),
    )
