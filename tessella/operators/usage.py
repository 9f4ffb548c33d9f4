"""Use of tokens and runs of failures over a log of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deltas(df: DataFrame, by: list[str], order: list[str], counters: list[str]) -> DataFrame:
    """Adds d_<counter>: what a cumulative counter grew by since the row before; all of it after a reset (or at first).

    Rows in which no counter grew are left out. Null counts as 0.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    for c in counters:
        now = F.coalesce(F.col(c), F.lit(0))
        grown = now - F.lag(now, 1, 0).over(w)
        df = df.withColumn(f"d_{c}", F.when(grown < 0, now).otherwise(grown))
    any_grown = F.lit(False)
    for c in counters:
        any_grown = any_grown | (F.col(f"d_{c}") > 0)
    return df.filter(any_grown)


def running(df: DataFrame, by: list[str], order: list[str], counters: list[str]) -> DataFrame:
    """Adds total_<counter>, the sum so far."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"total_{c}": F.sum(F.coalesce(F.col(c), F.lit(0))).over(w) for c in counters})


def totals(df: DataFrame, sets: list[list[str]], counters: list[str]) -> DataFrame:
    """Rows and sums of counters by each set of columns, in one pass; null where a column is not of the set."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets(sets, *columns).agg(F.count("*").alias("n_rows"), *(F.sum(c).alias(f"sum_{c}") for c in counters))


def streaks(df: DataFrame, by: list[str], order: list[str], fails: Column, ends: Column) -> DataFrame:
    """Adds streak: how many `fails` rows there were since the last `ends` row, this row included. Others neither count nor end it."""
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = F.sum(F.when(ends, 1).otherwise(0)).over(upto)
    inside = Window.partitionBy(*by, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_island", island).withColumn("streak", F.sum(F.when(fails, 1).otherwise(0)).over(inside).cast("int")).drop("_island")


def model_switches(df: DataFrame, by: list[str], order: list[str], fails: Column, ends: Column, threshold: int) -> DataFrame:
    """Adds model_no: how often the model was switched so far, once for each `threshold` fails in a row; a switch begins the count again."""
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hop = F.coalesce(fails, F.lit(False)) & (F.col("_streak") % threshold == 0)
    counted = streaks(df, by, order, fails, ends).withColumnRenamed("streak", "_streak")
    return counted.withColumn("model_no", F.sum(hop.cast("int")).over(upto).cast("int")).drop("_streak")


def longest_streaks(df: DataFrame, by: list[str]) -> DataFrame:
    """The longest streak and the number of rows that fail, by columns."""
    return df.groupBy(*by).agg(F.max("streak").alias("longest"), F.count("*").alias("n_rows"))


def report(totals_by_role: DataFrame, role: str, tokens: list[str]) -> DataFrame:
    """A line of a Markdown table for each role."""
    cells = [F.format_string("%,d", F.col(c).cast("long")) for c in tokens]
    return totals_by_role.select(role, F.concat(F.lit("| "), F.concat_ws(" | ", F.col(role), *cells), F.lit(" |")).alias("line"))
