"""Extensions over event streams; the batch engine needs none of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_within(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Events by id once, state bounded by the watermark (streaming or batch)."""
    marked = events.withWatermark("ts", delay)
    return marked.dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def windowed(events: DataFrame, size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(window_start, event_type, n, total) per tumbling window."""
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("decimal(20,6)")).cast("double"), 4).alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """(user_id, session_start, session_end, n) by gaps of inactivity."""
    s = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
