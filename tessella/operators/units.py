"""Quantities recorded in different units: amounts in a common unit, and records that agree only in it (problem 1)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import measures
from tessella.tables import cut_lineage, spread

#: Identities among quantities of one territory and year: product of the amounts to these powers, times the constant, is 1.
#: A density in inhabitants per km² is the population over the area in ha, times 100.
IDENTITIES = ({"DE01": -1.0, "PO01": 1.0, "AR01": -1.0, "constant": 100.0},)
#: What does not change from year to year: the area of a territory and the length of its coast.
CONSTANT = ("AR01", "LO02")
#: An identity is dropped where the stated amounts refute it: of at least CASES cases less than SHARE have a log residual
#: within HOLDS_WITHIN.
CASES, SHARE, HOLDS_WITHIN = 20, 0.5, math.log(1.1)
#: Unit choices whose log residuals differ by less than this are not told apart.
UNIQUE_GAP = math.log(1.05)
#: Without a stated amount that is met, what lies further than this from what is expected is not taken.
NEAR = math.log(2)
#: Two values are recorded differently if they differ by more than this share, and amounts agree within the other one.
VALUES_DIFFER, AMOUNTS_AGREE = 0.02, 0.005
#: Width of a band on the log scale: amounts that agree are at most one band apart.
BAND = -math.log(1 - AMOUNTS_AGREE) * 1.001

_CANDIDATES = "entry_id long, measure_key string, indicator string, place string, value double, stated boolean, candidates array<struct<a: double, b: double>>"


def candidates(entries: DataFrame, indicators: DataFrame) -> DataFrame:
    """One row for each entry_id with the units that its value may have, as (a, b) of amount = value * a + b.

    The unit column, the end of the label and the context each may state a unit; a bare number word in the label, like
    `(en miles)`, multiplies a plain unit. Different statements all stay as candidates; where none is stated (`stated`
    is false), every unit and scale of the dimension stays. Entries without a known indicator have none.

    Nulls: a null value, key, label, unit or context states nothing and never fails. Repeated entries become one row.
    Text is read before the shuffle that joins repeated entries, which moves a few numbers a row.
    """
    # The catalogue of indicators is a dimension table of fixed size; it is checked before it is sent to the workers.
    rows = indicators.select("indicator_code", "dimension").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 indicators: not a catalogue")
    dimension_of = {r[0]: r[1] for r in rows if r[0] is not None}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = {d: measures.all_units(d) for d in measures.BY_SPELLING}
        for batch in batches:
            codes, places, stated, found = [], [], [], []
            keys, values, labels, units, contexts = (batch.column(k).to_pylist() for k in range(1, 6))
            for key, value, label, unit, context in zip(keys, values, labels, units, contexts):
                code, _, place = (key or "").partition(":")
                dimension = dimension_of.get(code)
                codes.append(code or None)
                places.append(place or None)
                said = statements(dimension, value, label, unit, context) if dimension else []
                stated.append(bool(said))
                found.append([{"a": a, "b": b} for a, b in said or every.get(dimension, [])])
            kind = pa.list_(pa.struct([("a", pa.float64()), ("b", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(places, pa.string()), batch.column(2), pa.array(stated, pa.bool_()), pa.array(found, kind)],
                ["entry_id", "measure_key", "indicator", "place", "value", "stated", "candidates"],
            )

    texts = entries.select("entry_id", "measure_key", F.nanvl("value", F.lit(None).cast("double")).alias("value"), "label", "unit", "context")
    return spread(texts).mapInArrow(read, _CANDIDATES).dropDuplicates(["entry_id"])


def statements(dimension: str, value: float | None, label: str | None, unit: str | None, context: str | None) -> list[tuple[float, float]]:
    """The different units that unit, label and context of one entry state."""
    by_unit = measures.unit(dimension, unit) if unit else None
    by_label, word = measures.label_statement(dimension, label) if label else (None, 1.0)
    by_context = measures.context_statement(dimension, value, context) if context else None
    if word != 1.0:
        # The word scales a plain unit; beside a unit that is scaled already it may add to that scale or repeat it.
        scaled = [x for x in (by_unit, by_context) if x and x[0] not in (1.0, word)]
        by_unit, by_context = ((x[0] * word, x[1]) if x and x[0] != word else x for x in (by_unit, by_context))
        if scaled and dimension in ("money", "population"):
            return list(dict.fromkeys(x for x in (by_unit, by_context, *scaled) if x))
        if not by_unit and not by_context and dimension in ("money", "population"):
            by_label = (word, 0.0)
    return list(dict.fromkeys(x for x in (by_unit, by_label, by_context) if x))


def amounts(entries: DataFrame, indicators: DataFrame) -> DataFrame:
    """Each entry once with its amount in the common unit of its indicator.

    Columns: entry_id, measure_key, value, stated, factor, shift, amount, residual, is_unique.

    An entry with one candidate unit has its amount at once. For the others that combination of value and unit is chosen
    that has the least log residual against identities: entries of the same measure_key name one quantity, so a candidate
    that meets a stated amount of its key within AMOUNTS_AGREE comes first; then what stands nearest to the median of the
    key; then, where the key has no stated entry, to what IDENTITIES and CONSTANT make of other keys, unless the
    stated amounts refute them. is_unique is false where a second choice comes within UNIQUE_GAP of the first or
    nothing is known, and then the amount is null unless the unit was stated. Null values have null amounts.
    """
    return _resolved(cut_lineage(candidates(entries, indicators)))


def _resolved(read: DataFrame) -> DataFrame:
    """amounts() of candidates()."""
    amount = F.col("value") * F.col("factor") + F.col("shift")
    one = read.filter(F.size("candidates") == 1).withColumns({"factor": F.col("candidates")[0]["a"], "shift": F.col("candidates")[0]["b"], "residual": F.lit(0.0), "is_unique": F.lit(True)})
    open_choice = read.filter(F.size("candidates") != 1)
    stated = read.filter((F.size("candidates") == 1) & F.col("stated"))
    # Of the stated entries only those of keys with an open choice count, and what identities hold between.
    asked = stated.join(open_choice.select("measure_key").distinct(), "measure_key", "left_semi")
    known = open_choice.join(_expected(asked, stated), "measure_key", "left").join(_met(open_choice, asked), "entry_id", "left")
    known = known.withColumn("territory", _territory()).join(_constants(stated), "territory", "left").withColumn("expected", F.coalesce("expected", "constant"))
    ranked = """array_sort(transform(filter(candidates, c -> value * c.a + c.b > 0 and (expected is not null or met is not null)),
                c -> named_struct('residual', coalesce(element_at(met, named_struct('a', c.a, 'b', c.b)), abs(ln(value * c.a + c.b) - expected), 1000d), 'a', c.a, 'b', c.b)))"""
    picked = known.withColumn("ranked", F.expr(ranked.replace("element_at", "try_element_at")))
    first, second = F.get("ranked", F.lit(0)), F.get("ranked", F.lit(1))
    # Where one candidate meets a stated amount, others are far if they meet none, however near they are to the median.
    apart = F.when(F.size("met") > 0, (F.size("met") == 1) | (second["residual"] - first["residual"] > AMOUNTS_AGREE)).otherwise((first["residual"] <= NEAR) & ((F.size("ranked") == 1) | (second["residual"] - first["residual"] > UNIQUE_GAP)))
    best = picked.withColumns({"factor": first["a"], "shift": first["b"], "residual": first["residual"], "is_unique": F.coalesce(apart, F.lit(False))})
    # A stated unit stands even where the choice between statements is open: the first statement, the unit column's.
    best = best.withColumns({c: F.coalesce(F.col(c), F.when(F.col("stated"), F.col("candidates")[0][k])) for c, k in (("factor", "a"), ("shift", "b"))})
    kept = ["entry_id", "measure_key", "value", "stated", "factor", "shift", "residual", "is_unique"]
    return one.select(kept).unionByName(best.select(kept)).withColumn("amount", F.when(F.col("stated") | F.col("is_unique"), amount))


def _band(amount: Column) -> Column:
    return F.when(amount == 0, F.lit(0)).otherwise(F.floor(F.ln(F.abs(amount)) / BAND)).cast("long")


def _met(open_choice: DataFrame, stated: DataFrame) -> DataFrame:
    """entry_id and `met`: the candidates, as a map to their residual, whose amount a stated entry of the key has.

    An equi-join on key and band, so a hot key is spread over its bands; the stated side is one row for each band.
    """
    amount = F.col("value") * F.col("candidates")[0]["a"] + F.col("candidates")[0]["b"]
    held = stated.filter(amount > 0).groupBy("measure_key", _band(amount).alias("band")).agg(F.min(F.ln(amount)).alias("low"), F.max(F.ln(amount)).alias("high"))
    asked = (
        open_choice.filter(F.col("value").isNotNull() & F.col("measure_key").isNotNull())
        .select("entry_id", "measure_key", F.explode("candidates").alias("c"), "value")
        .withColumn("log", F.ln(F.col("value") * F.col("c.a") + F.col("c.b")))
        .filter("log is not null")
        .withColumn("band", F.explode(F.array(*(F.floor(F.col("log") / BAND).cast("long") + k for k in (-1, 0, 1)))))
    )
    gap = F.least(F.abs(F.col("log") - F.col("low")), F.abs(F.col("log") - F.col("high")))
    near = asked.join(held, ["measure_key", "band"]).withColumn("gap", F.when(F.col("log").between(F.col("low"), F.col("high")), 0.0).otherwise(gap)).filter(F.col("gap") <= -math.log(1 - AMOUNTS_AGREE))
    return near.groupBy("entry_id", "c").agg(F.min("gap").alias("gap")).groupBy("entry_id").agg(F.map_from_entries(F.collect_list(F.struct("c", "gap"))).alias("met"))


def _expected(asked: DataFrame, stated: DataFrame) -> DataFrame:
    """For each measure_key of `asked` the log of the amount that it should have: the median of its stated entries, else what
    an identity makes of other keys of `stated`.

    The median is a sketch that is merged map-side, so a key of any number of entries is one small row before the shuffle.
    An identity that the medians of the stated entries refute does not count.
    """
    own, found = _medians(asked), []
    bound = _medians(stated.filter(F.col("indicator").isin(*{k for identity in IDENTITIES for k in identity})))
    for identity in IDENTITIES:
        powers = {k: v for k, v in identity.items() if k != "constant"}
        wide = bound.filter(F.col("indicator").isin(*powers)).groupBy("place").agg(*(F.max(F.when(F.col("indicator") == k, F.col("own"))).alias(k) for k in powers))
        rest = lambda but: sum((F.col(j) * p for j, p in powers.items() if j != but), F.lit(math.log(identity["constant"])))  # noqa: B023, E731
        holds = _holds(wide.select(rest(None).alias("residual")))
        found += [wide.select(F.concat(F.lit(f"{k}:"), "place").alias("measure_key"), (-rest(k) / p).alias("implied")).crossJoin(holds) for k, p in powers.items()]
    implied = reduce(DataFrame.unionByName, found).filter("holds and implied is not null")
    both = own.select("measure_key", "own", F.lit(None).cast("double").alias("implied")).unionByName(implied.select("measure_key", F.lit(None).cast("double").alias("own"), "implied"))
    return both.groupBy("measure_key").agg(F.coalesce(F.max("own"), F.avg("implied")).alias("expected"))


def _medians(stated: DataFrame) -> DataFrame:
    """The median log amount of the stated entries of each measure_key: own."""
    amount = F.col("value") * F.col("candidates")[0]["a"] + F.col("candidates")[0]["b"]
    return stated.filter(amount > 0).groupBy("measure_key", "indicator", "place").agg(F.percentile_approx(F.ln(amount), 0.5, 1000).alias("own"))


def _territory() -> Column:
    return F.concat_ws(":", "indicator", F.substring_index("place", ":", 1))


def _constants(stated: DataFrame) -> DataFrame:
    """territory and `constant`: the log amount over all years of what does not change in time, where years agree."""
    years = _medians(stated.filter(F.col("indicator").isin(*CONSTANT))).select("indicator", _territory().alias("territory"), "own")
    every = years.groupBy("indicator", "territory").agg(F.percentile_approx("own", 0.5, 1000).alias("constant"))
    holds = _holds(years.join(every, ["indicator", "territory"]).select("indicator", (F.col("own") - F.col("constant")).alias("residual")), "indicator")
    return every.join(holds.filter("holds"), "indicator").select("territory", "constant")


def _holds(residuals: DataFrame, *by: str) -> DataFrame:
    """Whether an identity stands against the stated amounts, in all or by columns."""
    r = F.col("residual")
    return residuals.filter(r.isNotNull()).groupBy(*by).agg(((F.count("*") < CASES) | (F.count_if(F.abs(r) <= HOLDS_WITHIN) >= SHARE * F.count("*"))).alias("holds"))


def same_amount_pairs(entries: DataFrame, indicators: DataFrame) -> DataFrame:
    """Pairs of entries of one measure_key whose values as recorded differ while their amounts in the common unit agree.

    Columns entry_id_a < entry_id_b. Values differ by more than VALUES_DIFFER, amounts by at most AMOUNTS_AGREE, each of
    the larger absolute value. Entries without stated unit, measure_key or value are in no pair.

    Not all pairs of a key are formed. Amounts are put in bands as wide as the agreement, on a log scale, so that what
    agrees is in the same or the next band; and as entries of one unit cannot agree in amount but differ in value (save
    on scales with a shifted zero), an entry looks only in the bands of the greater units that its key has. Nearly every
    candidate is a result, whatever the size of a key, and a hot key is spread over its bands and units.
    """
    read = cut_lineage(candidates(entries.filter(F.col("measure_key").isNotNull() & F.col("value").isNotNull()), indicators).filter("stated"))
    sized = (
        _resolved(read)
        .filter("amount is not null")
        .select("entry_id", "measure_key", "value", "amount", F.struct("factor", "shift").alias("unit"), F.signum("amount").cast("int").alias("sign"), _band(F.col("amount")).alias("band"))
    )
    units = sized.groupBy("measure_key").agg(F.collect_set("unit").alias("units"))
    other = F.explode(F.filter("units", lambda u: (u > F.col("unit")) | ((u == F.col("unit")) & (u["shift"] != 0))))
    seekers = (
        sized.join(units, "measure_key")
        .select("measure_key", "sign", "band", "unit", F.col("entry_id").alias("id"), F.col("value").alias("v"), F.col("amount").alias("q"), other.alias("sought"))
        .withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    )
    found = seekers.alias("s").join(
        sized.alias("t"),
        (F.col("s.measure_key") == F.col("t.measure_key"))
        & (F.col("s.sign") == F.col("t.sign"))
        & (F.col("s.band") == F.col("t.band"))
        & (F.col("s.sought") == F.col("t.unit"))
        & ((F.col("s.unit") != F.col("t.unit")) | (F.col("s.id") < F.col("t.entry_id")))
        & (F.abs(F.col("v") - F.col("value")) > VALUES_DIFFER * F.greatest(F.abs("v"), F.abs("value")))
        & (F.abs(F.col("q") - F.col("amount")) <= AMOUNTS_AGREE * F.greatest(F.abs("q"), F.abs("amount"))),
    )
    return found.select(F.least("id", "entry_id").alias("entry_id_a"), F.greatest("id", "entry_id").alias("entry_id_b"))
