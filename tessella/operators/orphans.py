"""References to records that do not exist at their time (problem 5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.tables import clean_id


def references(df: DataFrame, table_name: str, record_id: str, keys: str, at: str) -> DataFrame:
    """Long form of an array column of keys: table_name, record_id, key, t. Null and blank items name nothing."""
    return df.select(F.lit(table_name).alias("table_name"), F.col(record_id).cast("string").alias("record_id"), F.col(at).cast("timestamp").alias("t"), F.explode(keys).alias("item")).select(
        "table_name", "record_id", clean_id(F.col("item")).alias("key"), "t"
    ).filter("key is not null")


def orphan_references(parents: DataFrame, key: str, begin: str, end: str, *children: DataFrame) -> DataFrame:
    """References (of `references`) whose key has no parent row that is there at their time: begin <= t < end.

    A null end is open; a null begin, and an end not after its begin, make a row that is never there. A reference
    without a time has no parent. Columns table_name, record_id, key, t; each (table_name, record_id, key, t) once.

    Parents and children are united in long form, tagged, and grouped by key: a row that begins adds one to the number
    of parents alive, its end takes one away, and references before which none is alive lack the parent's flag. A key
    may hold a third of all rows, so groups are cut into days: sums by key and day, which shrink before they are
    shuffled, say how many parents are alive when a day begins, and only rows of one key and day meet in one task.
    """
    refs = reduce(DataFrame.unionByName, children).distinct()
    parent = parents.select(clean_id(F.col(key)).alias("key"), F.col(begin).cast("timestamp").alias("b"), F.col(end).cast("timestamp").alias("e")).filter("key is not null and b is not null and (e is null or e > b)")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("table_name", "record_id")]
    changes = parent.select("key", F.explode(F.filter(F.array(F.struct(F.col("b").alias("t"), F.lit(1).alias("change")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("change"))), lambda x: x["t"].isNotNull())).alias("x"))
    day = F.unix_date(F.to_date("t")).alias("day")
    long = changes.select("key", "x.t", "x.change", F.lit(False).alias("is_child"), *nothing).unionByName(
        refs.filter("t is not null").select("key", "t", F.lit(0).alias("change"), F.lit(True).alias("is_child"), "table_name", "record_id")
    )
    days = long.groupBy("key", day).agg(F.sum("change").alias("change"), F.bool_or("is_child").alias("has_child"))
    before = Window.partitionBy("key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.withColumn("change", F.coalesce(F.sum("change").over(before), F.lit(0))).filter("has_child").select("key", "day", F.lit(None).cast("timestamp").alias("t"), F.col("change").cast("int"), F.lit(False).alias("is_child"), *nothing)
    rows = long.withColumn("day", F.unix_date(F.to_date("t"))).unionByName(carried)
    # Nulls come first: the carried number; of changes and references at one instant, the changes.
    alive = F.sum("change").over(Window.partitionBy("key", "day").orderBy("t", "is_child").rowsBetween(Window.unboundedPreceding, 0))
    late = rows.withColumn("alive", alive).filter("is_child and alive <= 0").select("table_name", "record_id", "key", "t")
    return late.unionByName(refs.filter("t is null").select("table_name", "record_id", "key", "t"))


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """Number of orphan references and of records that have any, by table and month; null months for null times."""
    return orphans.groupBy("table_name", F.date_format("t", "yyyy-MM").alias("month")).agg(F.count("*").alias("n_references"), F.countDistinct("record_id").alias("n_records"))
