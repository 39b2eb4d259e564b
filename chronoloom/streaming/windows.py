"""Sessions and tumbling bins over streams, with a watermark for late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def stream_sessions(stream: DataFrame, keys: Sequence[str], time: str, value: str, gap: str, late: str) -> DataFrame:
    """Sessions that end ``gap`` after their last row: start, end, count, mean and peak."""
    w = F.session_window(time, gap)
    out = stream.withWatermark(time, late).groupBy(w, *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("peak"))
    return out.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "mean", "peak")


def stream_bins(stream: DataFrame, keys: Sequence[str], time: str, value: str, width: str, late: str) -> DataFrame:
    """Means of tumbling bins."""
    out = stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))
    return out.select(*keys, F.col("window.start").alias("start"), "mean", "n")
