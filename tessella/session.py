"""Session settings that the operators' semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings of meaning, not of size: they hold at every scale. Sizes (partitions, memory) belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(master: str | None = None, app: str = "tessella", **more: str) -> SparkSession:
    """A session with SETTINGS; `more` are further settings, with `__` for the dots of a name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
