"""Request counts per tumbling time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .errors import tagged

WATERMARK = "2 minutes"


def windowed_count(
    df: DataFrame,
    keys: Sequence[str] = (),
    width: str = "1 minute",
    watermark: str | None = WATERMARK,
    ts_col: str = "timestamp",
) -> DataFrame:
    """Rows per window and key: ``time_window``, the keys and ``request_count``.

    A batch frame ignores the watermark. Counts are combined before the shuffle,
    so a key that holds a third of all rows sends one row per task and window.
    """
    if df.isStreaming and watermark:
        df = df.withWatermark(ts_col, watermark)
    return df.groupBy(F.window(ts_col, width).alias("time_window"), *keys).agg(
        F.count("*").alias("request_count")
    )


def traffic(
    df: DataFrame, width: str = "1 minute", watermark: str | None = WATERMARK, bucket: str = "minute"
) -> DataFrame:
    """Requests per window, one minute wide by default."""
    counts = windowed_count(df, (), width, watermark)
    return tagged(counts.select(F.col("time_window.start").alias(bucket), "request_count"), "traffic")


def ip_activity(df: DataFrame, width: str = "2 minutes", watermark: str | None = WATERMARK) -> DataFrame:
    """Requests per client and window."""
    counts = windowed_count(df, ("ip",), width, watermark)
    return tagged(counts.select(F.col("time_window.start").alias("window_start"), "ip", "request_count"), "top_ips")


def url_activity(df: DataFrame, width: str = "2 minutes", watermark: str | None = WATERMARK) -> DataFrame:
    """Requests per page and window."""
    counts = windowed_count(df, ("url",), width, watermark)
    return tagged(
        counts.select(F.col("time_window.start").alias("window_start"), "url", "request_count"), "url_analysis"
    )


def request_rate(df: DataFrame, width: str = "1 minute", watermark: str | None = WATERMARK) -> DataFrame:
    """Requests per second of each window."""
    start, end = F.col("time_window.start"), F.col("time_window.end")
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    return windowed_count(df, (), width, watermark).select(
        start.alias("window_start"),
        "request_count",
        F.round(F.col("request_count") / seconds, 6).alias("requests_per_second"),
    )
