"""Streams over event tables: windows with watermarks, streaks with state, counters, idempotent upserts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tessella.tables import shared_folder


def event_stream(spark: SparkSession, folder: str, pattern: str, schema: StructType, time: str = "ts", files: int = 8) -> DataFrame:
    """A stream of the Parquet files of a folder; zoneless times become instants, as watermarks need."""
    df = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).parquet(folder)
    return df.withColumn(time, F.col(time).cast("timestamp"))


def tumbling(df: DataFrame, every: str, by: list[str], time: str = "ts", late: str = "1 hour", value: str = "value") -> DataFrame:
    """Rows and sum of `value` in windows that follow each other; the same on streams and on tables."""
    return _windows(df, F.window(time, every), by, time, late, value)


def sliding(df: DataFrame, length: str, every: str, by: list[str], time: str = "ts", late: str = "1 hour", value: str = "value") -> DataFrame:
    """Rows and sum of `value` in windows that overlap."""
    return _windows(df, F.window(time, length, every), by, time, late, value)


def sessions(df: DataFrame, gap: str, by: list[str], time: str = "ts", late: str = "1 hour", value: str = "value") -> DataFrame:
    """Rows and sum of `value` in sessions that end after a gap."""
    return _windows(df, F.session_window(time, gap), by, time, late, value)


def _windows(df: DataFrame, window, by, time, late, value) -> DataFrame:
    marked = df.withWatermark(time, late) if df.isStreaming else df
    grouped = marked.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("w.start").alias("begin"), F.col("w.end").alias("end"), *by, "n", "total")


def streak_state(df: DataFrame, key: str, kind: str, order: str, fails: str, ends: str, time: str | None = None, late: str = "1 hour") -> DataFrame:
    """For each key its streak of `fails` rows after each batch of a stream, and the longest so far; `ends` rows end a streak.

    Rows of one batch are taken in `order`; a later batch must hold later rows. State is two numbers a key.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, longest = state.get if state.exists else (0, 0)
        for x in _in_order(batches, [order], kind):
            streak = 0 if x == ends else streak + (x == fails)
            longest = max(longest, streak)
        state.update((streak, longest))
        yield pd.DataFrame({key: [k[0]], "streak": [streak], "longest": [longest]})

    marked = df.withWatermark(time, late) if time else df
    kind_of = df.schema[key].dataType.simpleString()
    return marked.groupBy(key).applyInPandasWithState(step, f"{key} {kind_of}, streak int, longest int", "streak int, longest int", "update", GroupStateTimeout.NoTimeout)


def _in_order(batches: Iterator[pd.DataFrame], order: list[str], column: str):
    """The values of a column in an order: only it and the order are kept of the rows of a key in one batch of the stream."""
    return pd.concat([b[[*order, column]] for b in batches]).sort_values(order)[column]


def counter_state(df: DataFrame, key: str, order: str, counter: str) -> DataFrame:
    """For each key, after each batch, what a cumulative counter grew by in it; a counter that falls was reset."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else 0
        grown = 0
        for now in _in_order(batches, [order], counter):
            grown += now - last if now >= last else now
            last = now
        state.update((int(last),))
        yield pd.DataFrame({key: [k[0]], "grown": [int(grown)]})

    kind_of = df.schema[key].dataType.simpleString()
    return df.groupBy(key).applyInPandasWithState(step, f"{key} {kind_of}, grown long", "last long", "update", GroupStateTimeout.NoTimeout)


def once(df: DataFrame, key: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def run_to_table(df: DataFrame, target: str, checkpoint: str, mode: str = "append", form: str = "parquet") -> None:
    """Runs what is there of a stream to its end, into files; a second run goes on where the first ended."""
    df.writeStream.format(form).outputMode(mode).option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start().awaitTermination()


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], Any], checkpoint: str, mode: str = "update") -> None:
    """Runs what is there of a stream to its end, each micro-batch through a function, like Store.upsert."""
    df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_to_folder(df: DataFrame, mode: str, folder: str | None = None) -> DataFrame:
    """Runs what is there of a stream to its end into files and reads them: in mode `complete` what the last batch gave, else
    what all gave. Without a folder a new one in the folder that the executors share; nothing passes through the driver."""
    spark = df.sparkSession
    root = folder or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    out, empty = f"{root}/rows", spark.createDataFrame([], df.schema)
    empty.write.mode("append").parquet(out)
    run_batches(df, lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out), f"{root}/offsets", mode)
    return spark.read.schema(df.schema).parquet(out)
