"""Session settings: adaptive execution does the coalescing, skew splitting and join choice."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "tripleloom", **settings: str) -> SparkSession:
    """A session with SETTINGS; keyword arguments use ``__`` for dots."""
    chosen = SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(app).config(map=chosen).getOrCreate()
