"""A session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: measured join sides, split skewed partitions, rebalanced writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of a partition after a shuffle, and so of a fact file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Zone-less timestamps ignore it; zoned ones are read as UTC wall clock.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "meterstar", **settings: str) -> SparkSession:
    """Get or create a session; further settings, dots written as __, come last."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
