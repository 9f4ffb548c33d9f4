"""Quality gates: each one is a frame with a single row, so that gates unite to one table."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import exact_mean, numbers
from tessella.operators.lineage import section_references
from tessella.tables import clean_id

GATE = ("gate_name", "passed", "score", "items_checked", "items_passed", "items_failed")
TOLERANCE, MATCH_RATE = 0.05, 0.5
#: Units whose missing numbers weigh more, and the value above which any number does.
WEIGHTY_UNITS, WEIGHTY_VALUE = ("habitantes", "hab", "km²", "ha", "hectáreas"), 10_000


def _gate(name: str, df: DataFrame, passed: Column, score: Column, checked: Column, ok: Column, failed: Column) -> DataFrame:
    return df.select(F.lit(name).alias("gate_name"), passed.alias("passed"), score.cast("double").alias("score"), checked.cast("long").alias("items_checked"), ok.cast("long").alias("items_passed"), failed.cast("long").alias("items_failed"))


def confidence_gate(rows: DataFrame, name: str, threshold: float = 0.85) -> DataFrame:
    """Passes if no row's confidence is under the threshold; the score is the mean. Null confidence counts as 0; no rows pass with 1."""
    c = F.coalesce("confidence", F.lit(0.0))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(c < threshold).alias("low"), exact_mean(c).alias("mean"))
    return _gate(name, counts, F.col("low") == 0, F.coalesce("mean", F.lit(1.0)), F.col("n"), F.col("n") - F.col("low"), F.col("low"))


def draft_numbers(sections: DataFrame, mode: str = "plain") -> DataFrame:
    """The different numbers in the texts of sections."""
    return sections.select(F.explode(numbers(F.col("content"), mode)).alias("x")).select(F.col("x.value").alias("value")).distinct()


def band_semi(left: DataFrame, values: DataFrame, tolerance: float = TOLERANCE, anti: bool = False) -> DataFrame:
    """Rows of `left` whose `value` has some of `values` within a share `tolerance` of it; with `anti` those that have none.

    0 matches only 0; null matches nothing. Not a nested loop: values are put in bands on a log scale by sign, each row
    looks in its band and both next to it by an equi-join, and the exact test follows. tolerance must be under 1.
    """
    width = -math.log(1 - tolerance)
    band = lambda v: F.when(v == 0, F.lit(0)).otherwise(F.floor(F.ln(F.abs(v)) / width)).cast("long")
    right = values.filter("value is not null").select(F.col("value").alias("held"), F.signum("value").cast("int").alias("sign")).withColumn("band", F.explode(F.array(*(band(F.col("held")) + k for k in (-1, 0, 1))))).distinct()
    probe = left.withColumn("_sign", F.signum("value").cast("int")).withColumn("_band", band(F.col("value")))
    near = (F.col("_sign") == F.col("sign")) & (F.col("_band") == F.col("band")) & (F.abs(F.col("held") - F.col("value")) <= tolerance * F.abs("value"))
    return probe.join(right, near, "left_anti" if anti else "left_semi").drop("_sign", "_band")


def severity(value: Column, unit: Column) -> Column:
    """How much a missing number weighs: `medium` for some units and for great values, else `low`."""
    return F.when(F.coalesce(unit.isin(*WEIGHTY_UNITS), F.lit(False)) | F.coalesce(value > WEIGHTY_VALUE, F.lit(False)), "medium").otherwise("low")


def unmatched_numbers(numeric: DataFrame, sections: DataFrame, tolerance: float = TOLERANCE, mode: str = "plain") -> DataFrame:
    """Numeric entries that no number of the draft comes near, with their severity. Units play no part in the match."""
    return band_semi(numeric, draft_numbers(sections, mode), tolerance, anti=True).withColumn("severity", severity(F.col("value"), F.col("unit")))


def numeric_gate(numeric: DataFrame, sections: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Passes if MATCH_RATE of the numeric entries are in the draft; no entries pass with 1."""
    missing = unmatched_numbers(numeric, sections, tolerance).agg(F.count("*").alias("missing"))
    counts = numeric.agg(F.count("*").alias("n")).crossJoin(missing)
    rate = F.coalesce(F.try_divide(F.col("n") - F.col("missing"), F.col("n")), F.lit(1.0))
    return _gate("numeric_reconciliation", counts, rate >= MATCH_RATE, rate, F.col("n"), F.col("n") - F.col("missing"), F.col("missing"))


def completeness_gate(sections: DataFrame, expected: DataFrame, summaries: DataFrame, least: float = 0.5) -> DataFrame:
    """Passes if every expected heading (column heading) is in the draft and enough chunks of the summaries are used.

    Coverage takes all chunks that the draft names, known or not, over those with a summary, so it can exceed 1.
    """
    headings = sections.select("heading").distinct()
    wanted = expected.select("heading").distinct()
    used = section_references(sections).select("chunk_id").distinct()
    known = summaries.select(clean_id(F.col("chunk_id")).alias("chunk_id")).filter("chunk_id is not null").distinct()
    one = lambda df, name: df.agg(F.count("*").alias(name))
    counts = one(wanted, "wanted").crossJoin(one(wanted.join(headings, "heading", "left_anti"), "missing")).crossJoin(one(used, "used")).crossJoin(one(known, "known")).crossJoin(one(known.join(used, "chunk_id", "left_anti"), "unused"))
    cover = F.coalesce(F.try_divide("used", "known"), F.lit(1.0))
    return _gate("completeness", counts, (F.col("missing") == 0) & (cover >= least), cover, F.col("wanted") + F.col("known"), F.col("wanted") - F.col("missing") + F.col("used"), F.col("missing") + F.col("unused"))


def review_gate(annotations: DataFrame, overall: Column, high_risks: Column, most_rejected: float = 0.15, least_confidence: float = 0.7) -> DataFrame:
    """Passes if few annotations reject, confidence is high enough and no high risk is open; no annotations pass with 1.

    `annotations` has verdict; overall and high_risks are aggregate columns over it.
    """
    counts = annotations.agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "accept").alias("accepted"), F.count_if(F.col("verdict") == "reject").alias("rejected"), overall.alias("overall"), high_risks.alias("high"))
    good = (F.col("rejected") <= most_rejected * F.col("n")) & (F.col("overall") >= least_confidence) & (F.col("high") == 0)
    none = F.col("n") == 0
    return _gate("review_quality", counts, none | good, F.when(none, 1.0).otherwise(F.col("overall")), F.col("n"), F.col("accepted"), F.col("rejected"))


def slide_gate(slides: DataFrame, least: int = 80, most: int = 100, bullets: int = 5) -> DataFrame:
    """Passes if the number of slides is in range and none has too many bullets. `slides` has bullets."""
    counts = slides.agg(F.count("*").alias("n"), F.count_if(F.size("bullets") > bullets).alias("over"))
    in_range = F.col("n").between(least, most)
    passed = in_range & (F.col("over") == 0)
    return _gate("slide_quality", counts, passed, F.when(passed, 1.0).otherwise(0.5), F.col("n"), F.col("n") - F.col("over"), F.col("over") + F.when(in_range, 0).otherwise(1))


def all_gates(*gates: DataFrame) -> DataFrame:
    """Gates as one table."""
    return reduce(DataFrame.unionByName, gates)


def gate_report(gates: DataFrame) -> DataFrame:
    """A block of Markdown for each gate: gate_name, text."""
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return gates.select("gate_name", F.format_string("## %s: %s\n- Score: %.2f\n- Items: %d/%d passed", F.col("gate_name"), status, F.col("score"), F.col("items_passed"), F.col("items_checked")).alias("text"))


def first_items(items: Column, limit: int = 10) -> Column:
    """The first items of a list as text, and how many more there are."""
    more = F.size(items) - limit
    return F.concat(F.slice(items, 1, limit), F.when(more > 0, F.array(F.format_string("... and %d more", more))).otherwise(F.array().cast("array<string>")))


def verdict_counts(annotations: DataFrame, *by: str) -> DataFrame:
    """accept, edit and reject counts; unknown and null verdicts count as accept."""
    v = F.when(F.col("verdict").isin("edit", "reject"), F.col("verdict")).otherwise("accept")
    return annotations.groupBy(*by).agg(*(F.count_if(v == k).alias(f"n_{k}") for k in ("accept", "edit", "reject")))


def review_queue(summaries: DataFrame, annotations: DataFrame, threshold: float = 0.85, risks: DataFrame | None = None) -> DataFrame:
    """What people should look at: summaries of low confidence, annotations that reject or are of high risk, and entries
    of high level of the risk register. `risks` has level, description and affected_sections, a list of ids."""
    low = summaries.filter(F.coalesce("confidence", F.lit(0.0)) < threshold).select(F.lit("low_confidence_summary").alias("kind"), F.col("summary_id").alias("item_id"), F.format_string("confidence %.3f", F.coalesce("confidence", F.lit(0.0))).alias("reason"))
    risky = annotations.filter("verdict = 'reject' or risk_level = 'high'").select(F.lit("high_risk_annotation").alias("kind"), F.col("section_id").alias("item_id"), F.concat_ws(" ", "verdict", "risk_level").alias("reason"))
    queue = low.unionByName(risky, allowMissingColumns=True)
    if risks is None:
        return queue
    entries = risks.filter("level = 'high'").select(F.lit("high_risk_register_entry").alias("kind"), F.concat_ws(", ", "affected_sections").alias("item_id"), F.coalesce("description", F.lit("")).alias("reason"))
    return queue.unionByName(entries)
