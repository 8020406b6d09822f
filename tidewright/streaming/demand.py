"""An extension: daily demand from a stream of events, with late rows up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_demand(events: DataFrame, late: str = "2 days", time: str = "ts", by: str = "event_type", value: str = "value") -> DataFrame:
    """Counts and sums a day and key. events: a stream (or a table) with a timestamp column."""
    at = events.withColumn("_at", F.col(time).cast("timestamp"))
    at = at.withWatermark("_at", late) if events.isStreaming else at
    day = F.window("_at", "1 day")
    return at.groupBy(day.alias("_day"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("_day.start").cast("date").alias("date"), by, "n", "total")
