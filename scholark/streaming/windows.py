"""Window aggregates and deduplication that hold for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, ts: str, width: str, keys: list[str], value: str, late: str | None = None) -> DataFrame:
    """Counts and sums per window and keys; with ``late``, rows later than the watermark are left out of a stream."""
    rows = events.withWatermark(ts, late) if late else events
    got = rows.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n_events"), F.sum(value).alias("total"))
    return got.select(F.col("w.start").alias("window_start"), *keys, "n_events", "total")


def sessions(events: DataFrame, ts: str, gap: str, key: str, late: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, late) if late else events
    got = rows.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n_events"))
    return got.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n_events")


def once(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
