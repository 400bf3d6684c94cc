"""Streams: first-seen filter, late rows and counts by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(stream: DataFrame, key: Column, time: str, delay: str = "7 days") -> DataFrame:
    """Rows whose key was not seen before, state bounded by the watermark.  Works on a batch table too."""
    keyed = stream.withColumn("__key", key)
    if not stream.isStreaming:
        return keyed.dropDuplicates(["__key"]).drop("__key")
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def window_counts(stream: DataFrame, time: str, keys: list[str], size: str = "1 day", delay: str = "30 days") -> DataFrame:
    """Counts by tumbling window and keys; windows close once the watermark passed them."""
    out = stream.withWatermark(time, delay).groupBy(F.window(time, size), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), *keys, "n")


def is_late(event: str, loaded: str, by: str = "interval 7 days") -> Column:
    return F.coalesce(F.col(loaded) > F.col(event) + F.expr(by), F.lit(False))
