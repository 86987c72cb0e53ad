"""Streaming counterparts, beyond what a batch pipeline needs: call health, sessions, late duplicates.

Each function takes a batch or a streaming DataFrame with a timestamp column and
adds the watermark itself; the batch result is the one the stream ends with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _marked(df: DataFrame, ts: str, late: str) -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming else df


def tumbling_health(events: DataFrame, ts: str, by: str, failed: Column, late: str = "2 hours", size: str = "1 hour") -> DataFrame:
    """(window_start, by, n, n_failed) per tumbling window."""
    w = F.window(ts, size)
    return _marked(events, ts, late).groupBy(w, by).agg(F.count("*").alias("n"), F.sum(failed.cast("long")).alias("n_failed")).select(F.col("window.start").alias("window_start"), by, "n", "n_failed")


def sessions(events: DataFrame, ts: str, by: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(by, session_start, session_end, n): events of one key no further apart than *gap*."""
    return _marked(events, ts, late).groupBy(by, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def distinct_events(events: DataFrame, key: str, ts: str, late: str = "2 hours") -> DataFrame:
    """Every key once; a stream keeps a key for as long as late copies may come."""
    return _marked(events, ts, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
