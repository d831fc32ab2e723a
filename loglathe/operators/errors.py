"""Failed requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged(df: DataFrame, log_type: str) -> DataFrame:
    """Append the constant ``log_type`` that names the analysis."""
    return df.withColumn("log_type", F.lit(log_type))


def error_events(df: DataFrame, min_status: int = 400, keep: Sequence[str] = ()) -> DataFrame:
    """Requests with a status of at least ``min_status``; an unreadable status is none."""
    failed = df.filter(F.col("status_code") >= min_status)
    return tagged(failed.select("ip", "timestamp", "url", "status_code", "method", *keep), "error")


def error_trend(df: DataFrame, width: str = "1 hour", min_status: int = 400, watermark: str | None = "2 minutes") -> DataFrame:
    """Failed requests per window and status code."""
    from .windows import windowed_count  # it tags its rows with this module

    counts = windowed_count(df.filter(F.col("status_code") >= min_status), ("status_code",), width, watermark)
    return counts.select(F.col("time_window.start").alias("window_start"), "status_code", "request_count")
