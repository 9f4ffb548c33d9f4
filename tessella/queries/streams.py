"""Queries that run a stream over a table to its end and return its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.streaming import windows
from tessella.tables import table


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return windows.event_stream(spark, d, "events.parquet", table(spark, d, "events").schema)


def _result(df: DataFrame, mode: str = "complete") -> DataFrame:
    return windows.run_to_folder(df, mode)


def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Events by day and type; the stream equals the table."""
    out = _result(windows.tumbling(_stream(spark, d), "1 day", ["event_type"]))
    return out.select(F.date_format("begin", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Events in windows of two days that begin every day."""
    out = _result(windows.sliding(_stream(spark, d), "2 days", "1 day", ["event_type"]))
    return out.select(F.date_format("begin", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user that end after six hours without events."""
    out = _result(windows.sessions(_stream(spark, d), "6 hours", ["user_id"]))
    return out.select("user_id", F.date_format("begin", "yyyy-MM-dd HH:mm:ss").alias("begin"), "n")


def stream_streak(spark: SparkSession, d: str) -> DataFrame:
    """The longest streak of errors of each user between purchases, by a stateful stream."""
    out = _result(windows.streak_state(_stream(spark, d), "user_id", "event_type", "ts", "error", "purchase"), "update")
    return out.groupBy("user_id").agg(F.max("longest").alias("longest"))


def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Each event once within the watermark, counted by type."""
    out = _result(windows.once(_stream(spark, d), ["event_id"], "ts", "60 days"), "append")
    return out.groupBy("event_type").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (stream_tumbling, stream_sliding, stream_sessions, stream_streak, stream_dedupe)}
SQL = {
    "stream_tumbling": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "stream_sliding": "SELECT strftime(date_trunc('day', ts) - to_days(CAST(k AS INT)), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1, 2",
    "stream_sessions": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS begin, count(*) AS n FROM i GROUP BY user_id, k""",
    "stream_streak": """WITH i AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events), s AS (SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n FROM i GROUP BY user_id, k)
SELECT user_id, CAST(max(n) AS INT) AS longest FROM s GROUP BY 1""",
    "stream_dedupe": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
}
