"""A session with the settings that the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "tessera", **more: str) -> SparkSession:
    """The active session or a new one; more: settings with `_` for `.`."""
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **{k.replace("_", "."): v for k, v in more.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
