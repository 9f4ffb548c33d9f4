"""Joins over time and intervals that Spark has no operator of its own for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, take: list[str]) -> DataFrame:
    """Each row of `left` with the columns `take` of the last row of `right` of the same `by` at or before its time.

    One union and one window over time instead of a join on an inequality, so a key's rows are sorted once and no pairs
    are formed. At equal times rows of `right` come first. Null where there is none. Rows with a null time have none.
    """
    taken = F.struct(*(F.col(c) for c in take))
    rest = [c for c in left.columns if c not in (*by, time)]
    a = left.select(*by, time, F.lit(1).alias("_side"), F.struct(*rest).alias("_left"), F.lit(None).cast(right.select(taken.alias("x")).schema["x"].dataType).alias("_right"))
    b = right.filter(F.col(time).isNotNull()).select(*by, time, F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), taken.alias("_right"))
    w = Window.partitionBy(*by).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = F.when(F.col(time).isNotNull(), F.last("_right", ignorenulls=True).over(w))
    joined = a.unionByName(b).withColumn("_found", found).filter("_side = 1")
    return joined.select(*by, time, *(F.col(f"_left.{c}").alias(c) for c in rest), *(F.col(f"_found.{c}").alias(f"asof_{c}") for c in take))


def interval_join(points: DataFrame, spans: DataFrame, by: list[str], at: str, begin: str, end: str, seconds: int) -> DataFrame:
    """Rows of `points` with every row of `spans` of the same `by` that holds their time: begin <= at < end.

    Time is cut in cells of `seconds`; a span is joined in each cell that it touches, a point in its own, by an equi-join.
    Column names must differ but for `by`.
    """
    cell = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (seconds * 1_000_000)).cast("long")
    wide = spans.filter(F.col(end) > F.col(begin)).withColumn("_cell", F.explode(F.sequence(cell(F.col(begin)), cell(F.col(end)))))
    return points.withColumn("_cell", cell(F.col(at))).join(wide, [*by, "_cell"]).filter((F.col(at) >= F.col(begin)) & (F.col(at) < F.col(end))).drop("_cell")


def quantiles(df: DataFrame, by: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of a number by a column, interpolated between neighbours; nulls do not count.

    Values are put in cells between approximate quantiles of all (a sketch), counts of cells say in which one a rank falls,
    and only the values of these cells are sorted, each cell by itself: a group of any size is never in one task.
    """
    rows = df.select(F.col(by).alias("_by"), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    cuts = rows.agg(F.percentile_approx("_v", [k / 256 for k in range(1, 256)], 4000).alias("_cuts"))
    celled = rows.crossJoin(F.broadcast(cuts)).select("_by", "_v", F.aggregate("_cuts", F.lit(0), lambda a, c: a + (F.col("_v") > c).cast("int")).alias("_cell"))
    cells = celled.groupBy("_by", "_cell").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_by").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy("_by")))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor((F.col("_all") - 1) * q), F.ceil((F.col("_all") - 1) * q)) for q in shares.values()))))
    wanted = placed.withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))).filter("size(_ranks) > 0").select("_by", "_cell", "_before", "_all", "_ranks")
    inside = Window.partitionBy("_by", "_cell").orderBy("_v")
    at = celled.alias("c").join(wanted.alias("w"), F.col("c._by").eqNullSafe(F.col("w._by")) & (F.col("c._cell") == F.col("w._cell"))).select("c._by", "c._cell", "_v", "_before", "_all", "_ranks")
    ranked = at.withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1).filter(F.array_contains("_ranks", F.col("_rank")))
    value_at = lambda edge, q: F.max(F.when(F.col("_rank") == edge((F.col("_all") - 1) * q), F.col("_v")))
    out = ranked.groupBy("_by").agg(*(c for k, q in shares.items() for c in (value_at(F.floor, q).alias(f"{k}_low"), value_at(F.ceil, q).alias(f"{k}_high"))), F.max("_all").alias("_all"))
    between = lambda k, q: F.col(f"{k}_low") + (F.col(f"{k}_high") - F.col(f"{k}_low")) * (((F.col("_all") - 1) * q) - F.floor((F.col("_all") - 1) * q))
    return out.select(F.col("_by").alias(by), *(between(k, q).alias(k) for k, q in shares.items()))
