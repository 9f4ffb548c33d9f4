"""What is still to be done: resuming, retrying, latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.tables import clean_id


def is_failed(status: Column) -> Column:
    """Whether a status begins with failed_; false for null."""
    return F.coalesce(F.startswith(status, F.lit("failed_")), F.lit(False))


def needs_processing(status: Column) -> Column:
    """Whether a row is still to be done: no status, pending or failed."""
    return status.isNull() | (status == "pending") | is_failed(status)


def is_failed_image(kind: Column, status: Column, confidence: Column, described: Column) -> Column:
    """Whether an image's description failed: by its status; without one, if it was not described or confidence is at most 0.3."""
    return F.coalesce(kind.isin("image", "chart", "map"), F.lit(False)) & F.when(status == "success", False).when(is_failed(status), True).when(~F.coalesce(described, F.lit(False)), True).otherwise(F.coalesce(status.isNull() & (confidence <= 0.3), F.lit(False)))


def is_low_confidence_image(kind: Column, status: Column, confidence: Column, threshold: float) -> Column:
    """Whether an image was described with less confidence than the threshold; failed ones are not."""
    return F.coalesce(kind.isin("image", "chart", "map") & (status == "success") & (confidence < threshold), F.lit(False))


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row for each key: the greatest version, of equal versions the row of the greatest hash. Null keys are dropped.

    The row travels once, through an aggregation that shrinks map-side; no window sorts whole groups.
    """
    rest = [c for c in df.columns if c not in (key, version)]
    # Maps have no hash: the columns that hold one are hashed as JSON.
    ties = F.xxhash64(*(F.to_json(F.struct(c)) if "map<" in df.schema[c].dataType.simpleString() else F.col(c) for c in rest))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(version), ties)).alias("_r"), F.max(version).alias(version)).select(key, version, "_r.*")


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of `todo` whose key is not in `done`. Keys are compared without case and surrounding white space."""
    finished = done.select(clean_id(F.col(key)).alias("_k")).filter("_k is not null").distinct()
    return todo.join(finished, clean_id(F.col(key)) == F.col("_k"), "left_anti")


def reused_and_new(todo: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """`todo` with is_stored: whether the key is stored already."""
    have = stored.select(F.col(key).alias("_k")).filter("_k is not null").distinct().withColumn("_h", F.lit(True))
    return todo.join(have, F.col(key) == F.col("_k"), "left").withColumn("is_stored", F.coalesce("_h", F.lit(False))).drop("_k", "_h")


def retry_summary(before: DataFrame, after: DataFrame, key: str, by: list[str]) -> DataFrame:
    """By columns: how many rows failed before, and of those how many recovered or still fail. Both have key and failed."""
    then = before.filter("failed").select(key, *by)
    now = after.select(F.col(key).alias("_k"), F.col("failed").alias("_f"))
    return then.join(now, F.col(key) == F.col("_k"), "left").groupBy(*by).agg(F.count("*").alias("n_failed"), F.count_if(~F.coalesce("_f", F.lit(True))).alias("n_recovered"), F.count_if(F.coalesce("_f", F.lit(True))).alias("n_still"))
