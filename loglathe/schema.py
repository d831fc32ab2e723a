"""Schemas of the parsed events and of the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


EVENTS = _struct(
    ip=StringType(),
    timestamp=TimestampType(),
    method=StringType(),
    url=StringType(),
    protocol=StringType(),
    status_code=IntegerType(),
    content_size=LongType(),
    hour=StringType(),
    minute=StringType(),
    kafka_timestamp=TimestampType(),
    raw_log=StringType(),
)


@dataclass(frozen=True)
class ResultTable:
    """One stored analysis.

    ``keys`` name the columns of which only the newest version counts; a table
    without keys is a plain collection of rows.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...]
    time_col: str
    output_mode: str


# Analysis names, collection names and column mappings.
TABLES: dict[str, ResultTable] = {
    "error_logs": ResultTable(
        name="web-logs-errors",
        schema=_struct(
            ip=StringType(),
            timestamp=TimestampType(),
            url=StringType(),
            status_code=IntegerType(),
            method=StringType(),
            log_type=StringType(),
            processed_at=TimestampType(),
        ),
        keys=(),
        time_col="timestamp",
        output_mode="append",
    ),
    "traffic_by_minute": ResultTable(
        name="web-logs-traffic",
        schema=_struct(
            minute=TimestampType(),
            request_count=LongType(),
            log_type=StringType(),
            processed_at=TimestampType(),
        ),
        keys=("minute",),
        time_col="minute",
        output_mode="update",
    ),
    "top_ips": ResultTable(
        name="web-logs-ip-analysis",
        schema=_struct(
            window_start=TimestampType(),
            ip=StringType(),
            request_count=LongType(),
            log_type=StringType(),
            processed_at=TimestampType(),
        ),
        keys=("window_start", "ip"),
        time_col="window_start",
        output_mode="update",
    ),
    "url_analysis": ResultTable(
        name="web-logs-url-analysis",
        schema=_struct(
            window_start=TimestampType(),
            url=StringType(),
            request_count=LongType(),
            log_type=StringType(),
            processed_at=TimestampType(),
        ),
        keys=("window_start", "url"),
        time_col="window_start",
        output_mode="update",
    ),
    "rejects": ResultTable(
        name="web-logs-rejects",
        schema=_struct(
            raw_log=StringType(),
            kafka_timestamp=TimestampType(),
            cause=StringType(),
            processed_at=TimestampType(),
        ),
        keys=(),
        time_col="processed_at",
        output_mode="append",
    ),
}


def table_for(analysis: str) -> ResultTable:
    """The table of an analysis, by its exact name."""
    try:
        return TABLES[analysis]
    except KeyError:
        raise ValueError(f"unknown analysis {analysis!r}; expected one of {sorted(TABLES)}") from None
