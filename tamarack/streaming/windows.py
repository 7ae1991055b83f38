"""Windowed counts that run alike over tables and over streams, and streaming forms of the reference's loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watermarked(events: DataFrame, late: str | None) -> DataFrame:
    return events.withWatermark("ts", late) if late and events.isStreaming else events


def tumbling_counts(events: DataFrame, width: str, slide: str | None = None, late: str | None = "1 hour") -> DataFrame:
    """(start, n, total) of windows over ts; slide: sliding windows."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return _watermarked(events, late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "n", "total")


def session_counts(events: DataFrame, gap: str, late: str | None = "1 hour") -> DataFrame:
    """(user_id, start, n, total) of sessions that end where nothing comes for `gap`."""
    s = F.session_window("ts", gap).alias("s")
    return _watermarked(events, late).groupBy("user_id", s).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("user_id", F.col("s.start").alias("start"), "n", "total")


def new_batches(index: DataFrame, id_col: str = "batch_id", time_col: str = "delivered_at", late: str = "7 days") -> DataFrame:
    """A stream of the delivery index in which each batch comes once."""
    return index.withWatermark(time_col, late).dropDuplicatesWithinWatermark([id_col])


def near_in_time(left: DataFrame, right: DataFrame, key: str, seconds: int = 60, late: str = "10 minutes") -> DataFrame:
    """Pairs of two streams (key, id, ts) of one key that lie within so many seconds of each other."""
    a = left.withWatermark("ts", late).select(F.col(key).alias("key_a"), F.col("id").alias("id_a"), F.col("ts").alias("ts_a"))
    b = right.withWatermark("ts", late).select(F.col(key).alias("key_b"), F.col("id").alias("id_b"), F.col("ts").alias("ts_b"))
    span = F.expr(f"ts_b BETWEEN ts_a - INTERVAL {seconds} SECONDS AND ts_a + INTERVAL {seconds} SECONDS")
    return a.join(b, (F.col("key_a") == F.col("key_b")) & span).where("id_a != id_b")
