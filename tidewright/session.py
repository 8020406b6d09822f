"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidewright", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Adaptive execution on, times in UTC. On a cluster leave master and shuffle_partitions to its own settings."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.getOrCreate()
