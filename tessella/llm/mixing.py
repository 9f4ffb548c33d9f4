"""Mixing sources to target shares of tokens (problem 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.tokens import token_counts
from tessella.tables import cut_lineage

#: About how many documents of a stratum a slice of its order holds. Only the slice in which the draw ends is sorted.
SLICE = 5000


def counted_documents(documents: DataFrame, vocab: tuple[bytes, str] | None = None) -> DataFrame:
    """doc_id, source and n_tokens of each document that has tokens, once; written out, as a mix reads it several times."""
    counts = token_counts(documents.select("doc_id", "source", "text"), "text", vocab)
    once = counts.filter("doc_id is not null and source is not null and n_tokens > 0").groupBy("doc_id").agg(F.max(F.struct("n_tokens", "source")).alias("x"))
    return cut_lineage(once.select("doc_id", "x.source", "x.n_tokens"))


def allocation(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """For each plan and source the tokens to use: whole copies of all documents, and `rest` tokens of a sample.

    The total of a plan is the greatest at which no source needs more than max_repeats uses of each of its documents;
    if no source is capped, the tokens of its sources. Sources without documents get nothing, and the others keep their
    proportions. Null or negative shares are 0; a null cap is none; a cap under 0 is 0. Of repeated (plan, source) rows
    the greatest share and its smallest cap count.
    """
    held = counted.groupBy("source").agg(F.sum("n_tokens").alias("held"))
    asked = (
        targets.filter("plan_name is not null and source is not null")
        .select("plan_name", "source", F.greatest(F.coalesce(F.nanvl("target_share", F.lit(0.0)), F.lit(0.0)), F.lit(0.0)).alias("share"), F.when(F.col("max_repeats").isNotNull(), F.greatest(F.col("max_repeats").cast("long"), F.lit(0))).alias("cap"))
        .groupBy("plan_name", "source")
        .agg(F.max(F.struct(F.col("share"), (-F.coalesce("cap", F.lit(1 << 40))).alias("tight"))).alias("x"))
        .select("plan_name", "source", "x.share", F.nullif(-F.col("x.tight"), F.lit(1 << 40)).alias("cap"))
        .join(held, "source", "left")
        .withColumn("held", F.coalesce("held", F.lit(0)))
    )
    plan = Window.partitionBy("plan_name")
    usable = (F.col("held") > 0) & (F.col("share") > 0)
    most = F.min(F.when(usable & F.col("cap").isNotNull(), F.col("cap") * F.col("held") / F.col("share"))).over(plan)
    need = F.when(usable, F.col("share") * F.coalesce(most, F.sum(F.when(usable, F.col("held"))).over(plan))).otherwise(0.0)
    copies = F.floor(F.col("need") / F.col("held") + 1e-9)
    return (
        asked.withColumn("need", need)
        .withColumn("copies", F.when(F.col("held") > 0, F.least(copies, F.coalesce("cap", copies))).otherwise(0))
        .withColumn("rest", F.when(F.col("copies") < F.coalesce("cap", F.col("copies") + 1), F.greatest(F.col("need") - F.col("copies") * F.col("held"), F.lit(0.0))).otherwise(0.0))
        .select("plan_name", "source", "share", "cap", "held", "need", "copies", "rest")
    )


def inclusion(counted: DataFrame, alloc: DataFrame, seed: int = 1) -> DataFrame:
    """How the rest of each plan and source is sampled: plan_name, source, copies, lam, certain_from, strata.

    A document of n tokens has the inclusion probability lam * n, and is taken for certain from certain_from tokens on,
    where that would reach 1; lam makes the expected tokens the rest. Strata are octaves of n, so that the tokens of a
    sample of fixed size hardly vary: `strata` maps an octave to how many documents it gives (`take`), its mean
    probability and its slices. What is expected of the octaves of a source is rounded cumulatively from a random start,
    so that the size of the sample is fixed and no octave is favoured. No rest: null, null and an empty map.

    Works on one row for each source and number of tokens, of which there are no more than the longest text has.
    """
    sizes = counted.groupBy("source", "n_tokens").agg(F.count("*").alias("n"))
    by_size = alloc.filter("rest > 0").select("plan_name", "source", "rest").join(sizes, "source")
    larger = Window.partitionBy("plan_name", "source").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("plan_name", "source").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    lam = F.greatest(F.col("rest") - F.coalesce(F.sum(F.col("n") * F.col("n_tokens")).over(larger), F.lit(0)), F.lit(0.0)) / F.sum(F.col("n") * F.col("n_tokens") * F.col("n_tokens").cast("double")).over(so_far)
    open_size = F.col("lam") * F.col("n_tokens") < 1
    whole = Window.partitionBy("plan_name", "source")
    chances = (
        by_size.withColumn("lam", lam)
        .withColumns({"is_open": open_size, "lam": F.max_by(F.when(open_size, F.col("lam")), F.when(open_size, F.col("n_tokens"))).over(whole), "certain_from": F.min(F.when(~open_size, F.col("n_tokens"))).over(whole)})
        .withColumn("octave", F.floor(F.log2("n_tokens")).cast("int"))
    )
    strata = chances.filter("is_open").groupBy("plan_name", "source", "octave").agg(F.sum("n").alias("n_docs"), F.sum(F.col("n") * F.col("lam") * F.col("n_tokens")).alias("expected"))
    start = _uniform(F.lit("start"), F.lit(seed), F.col("plan_name"), F.col("source"))
    upto = F.sum("expected").over(Window.partitionBy("plan_name", "source").orderBy(F.col("octave").desc()).rowsBetween(Window.unboundedPreceding, 0))
    taken = strata.withColumn("upto", upto).withColumn("take", F.floor(F.col("upto") + start) - F.floor(F.col("upto") - F.col("expected") + start))
    part = F.struct("octave", F.struct("take", (F.col("expected") / F.col("n_docs")).alias("mean"), F.ceil(F.col("n_docs") / SLICE).alias("n_slices")).alias("s"))
    by_source = taken.groupBy("plan_name", "source").agg(F.map_from_entries(F.collect_list(part)).alias("strata"))
    rule = chances.groupBy("plan_name", "source").agg(F.first("lam").alias("lam"), F.first("certain_from").alias("certain_from"))
    return alloc.filter("copies > 0 or rest > 0").select("plan_name", "source", "copies").join(rule, ["plan_name", "source"], "left").join(by_source, ["plan_name", "source"], "left")


def _uniform(*of) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def mix(counted: DataFrame, targets: DataFrame, seed: int = 1) -> DataFrame:
    """Documents of each plan with their uses: plan_name, source, doc_id, n_uses, n_tokens (of one use).

    Each document of a source has its certain whole copies. The rest is drawn by Pareto order sampling with unequal
    inclusion probabilities (`inclusion`): in each stratum documents are ranked by the odds of a random number over the
    odds of their inclusion, and the first `take` are taken. Random numbers are hashes of seed, plan and doc_id: a mix can
    be made again. Null plans, sources and ids take no part; ties go by doc_id.

    A source may hold a third of all documents. A stratum is cut by rank in slices of about SLICE documents; counts of
    slices say in which one the draw ends, and only the documents of that slice are sorted.
    """
    # One row for each plan and source, written out, as the plan of what follows reads them several times.
    rules = cut_lineage(inclusion(counted, allocation(counted, targets), seed))
    odds = lambda p: p / (1 - p)
    u, chance = _uniform(F.lit(seed), F.col("plan_name"), F.col("doc_id")), F.col("lam") * F.col("n_tokens")
    is_certain = F.coalesce(F.col("n_tokens") >= F.col("certain_from"), F.lit(False))
    rows = (
        counted.join(rules, "source")
        .withColumn("octave", F.floor(F.log2("n_tokens")).cast("int"))
        .withColumn("s", F.when(~is_certain, F.try_element_at("strata", "octave")))
        .withColumn("rank", F.when(F.col("s").isNotNull(), odds(u) / odds(F.least(chance, F.lit(1 - 1e-12)))))
        # The rank in units of the stratum's mean odds is nearly a uniform number's odds, so slices are about equal.
        .withColumn("x", F.col("rank") * odds(F.least(F.col("s.mean"), F.lit(1 - 1e-12))))
        .withColumn("slice", F.least(F.floor(F.col("x") / (1 + F.col("x")) * F.col("s.n_slices")), F.col("s.n_slices") - 1))
        .select("plan_name", "source", "doc_id", "n_tokens", "copies", is_certain.alias("is_certain"), "octave", "slice", "rank", F.col("s.take").alias("take"))
    )
    stratum = ["plan_name", "source", "octave"]
    before = Window.partitionBy(*stratum).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.filter("slice is not null").groupBy(*stratum, "slice").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = rows.join(slices, [*stratum, "slice"], "left")
    ends_here = "slice is not null and before < take and before + n > take"
    whole = placed.filter(f"not coalesce({ends_here}, false)").withColumn("drawn", F.when(F.col("is_certain") | (F.col("before") + F.col("n") <= F.col("take")), 1).otherwise(0))
    inside = Window.partitionBy(*stratum, "slice").orderBy("rank", "doc_id")
    edge = placed.filter(ends_here).withColumn("drawn", F.when(F.col("before") + F.row_number().over(inside) <= F.col("take"), 1).otherwise(0))
    return whole.unionByName(edge).withColumn("n_uses", (F.col("copies") + F.col("drawn")).cast("int")).filter("n_uses > 0").select("plan_name", "source", "doc_id", "n_uses", "n_tokens")


def reached_shares(mixed: DataFrame, counted: DataFrame, targets: DataFrame) -> DataFrame:
    """By plan and source: target and reached share of tokens, documents, uses, most uses of a document, tokens."""
    used = mixed.groupBy("plan_name", "source").agg(F.count("*").alias("n_docs"), F.sum("n_uses").alias("n_uses"), F.max("n_uses").alias("most_uses"), F.sum(F.col("n_uses") * F.col("n_tokens")).alias("n_tokens"))
    every = allocation(counted, targets).select("plan_name", "source", F.col("share").alias("target_share"), F.col("cap").alias("max_repeats"))
    rows = every.join(used, ["plan_name", "source"], "left").fillna(0, ["n_docs", "n_uses", "most_uses", "n_tokens"])
    total = F.sum("n_tokens").over(Window.partitionBy("plan_name"))
    return rows.withColumn("reached_share", F.coalesce(F.try_divide(F.col("n_tokens"), total), F.lit(0.0)))
