"""Tables of a run in a folder: write, read, versions, upserts, append-only logs, texts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.operators.state import latest


class Store:
    """Parquet tables below a root folder. Writes are atomic by the commit protocol of the file committer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def exists(self, name: str) -> bool:
        """Whether a table was written."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def save(self, name: str, df: DataFrame, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
        """Writes a table; with partitions only those that `df` has rows of are replaced."""
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(name))

    def load(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """A table; if it was never written, an empty frame of `schema`, or an error without one."""
        if not self.exists(name) and self.exists(f"{name}.old"):
            return self.spark.read.parquet(self.path(f"{name}.old"))
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(self.path(name))

    def where(self, name: str, **equal) -> DataFrame:
        """Rows with given values; the filter reaches the scan, and folders of other partitions are not read."""
        df = self.load(name)
        for column, value in equal.items():
            df = df.filter(F.col(column) == F.lit(value))
        return df

    def version(self, name: str, version: int) -> DataFrame:
        return self.where(name, version=version)

    def first_version(self, name: str) -> DataFrame:
        """Version 1 of a table, else its least."""
        df = self.load(name)
        least = df.agg(F.coalesce(F.min(F.when(F.col("version") == 1, 1)), F.min("version")).alias("_v"))
        return df.join(least, F.col("version") == F.col("_v"), "left_semi")

    def last_version(self, name: str) -> DataFrame:
        df = self.load(name)
        return df.join(df.agg(F.max("version").alias("_v")), F.col("version") == F.col("_v"), "left_semi")

    def upsert(self, name: str, new: DataFrame, key: str, version: str) -> None:
        """Replaces rows of equal keys if the new version is greater. Null keys are dropped.

        Written whole beside the table, then swapped in by two renames: a crash leaves the old or the new table, under its
        name or that with `.old`, from which load() reads if the other is gone.
        """
        merged = latest(self.load(name).unionByName(new, allowMissingColumns=True), key, version) if self.exists(name) else latest(new, key, version)
        self.save(f"{name}.next", merged)
        self.drop(f"{name}.old")
        self._rename(name, f"{name}.old")
        self._rename(f"{name}.next", name)
        self.drop(f"{name}.old")

    def _rename(self, name: str, to: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        a, b = path(self.path(name)), path(self.path(to))
        system = a.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(a) and not system.rename(a, b):
            raise OSError(f"{a} could not be renamed")

    def append(self, name: str, df: DataFrame) -> None:
        """Adds rows to a log of JSON lines."""
        df.write.mode("append").json(self.path(name))

    def log(self, name: str, schema: StructType | str) -> DataFrame:
        """A log of JSON lines; lines that are no JSON of the schema are null in all columns but _corrupt_record, if it has that."""
        return self.spark.read.schema(schema).option("mode", "PERMISSIVE").json(self.path(name))

    def save_text(self, name: str, lines: DataFrame, order: str, text: str) -> None:
        """Writes one text file of lines in an order."""
        ordered = lines.select(order, text).repartition(1).sortWithinPartitions(order).select(F.coalesce(F.col(text), F.lit("")).alias("value"))
        ordered.write.mode("overwrite").text(self.path(name))

    def load_text(self, name: str) -> DataFrame:
        """A text as one row: value; no row if there is none."""
        return self.spark.read.text(self.path(name), wholetext=True) if self.exists(name) else self.spark.createDataFrame([], "value string")

    def drop(self, name: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def read_objects(spark: SparkSession, folder: str, schema: StructType, bad: bool = False) -> DataFrame:
    """Objects of JSON files, one in each file, with file_name; broken files are left out, or with `bad` only they are read."""
    corrupt = StructType([*schema.fields]).add("_corrupt_record", "string")
    df = spark.read.schema(corrupt).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(folder)
    df = df.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return df.filter(F.col("_corrupt_record").isNotNull()) if bad else df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def last_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in an order."""
    w = Window.partitionBy(*key).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
