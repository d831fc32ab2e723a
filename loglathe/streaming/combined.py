"""The four analyses from one read and one parse of the source, with exact counts of late rows.

Layout below the root::

    counts/batch_id=<n>/       what batch n adds to the windows: analysis, window_start, key, request_count
    error_logs/batch_id=<n>/   its failed requests
    progress/<n>               its rows, its watermark and the late rows up to it

The stream itself keeps no state: a batch is kept on the executors' disks, counted for all
analyses in one shuffle, and stored as increments that :func:`read_combined` adds up. The
watermark is that of the batches before, read from their progress, so a replayed batch drops the
same rows and replaces its own folders.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from ..functions.keys import stamp
from ..operators.errors import error_events, tagged
from ..operators.windows import WATERMARK
from ..schema import table_for
from ..store import paths
from .sinks import TRIGGER, each_batch, query_of


class Counted(NamedTuple):
    """An analysis that counts: seconds of a window, the column counted by, names in its table."""

    seconds: int
    key: str | None
    start: str
    log_type: str


COUNTED: dict[str, Counted] = {
    "traffic_by_minute": Counted(60, None, "minute", "traffic"),
    "top_ips": Counted(120, "ip", "window_start", "top_ips"),
    "url_analysis": Counted(120, "url", "window_start", "url_analysis"),
}
ERRORS = "error_logs"
POSITION = ("kafka_partition", "kafka_offset")

_COUNTS = "analysis string, window_start timestamp, key string, request_count bigint, processed_at timestamp, batch_id bigint"
_NOTHING = {"batch_id": -1, "input_rows": 0, "total_rows": 0, "watermark": None, "next_watermark": None, "late_rows": {}, "total_late_rows": {}}


def _start(seconds: int) -> Column:
    micros = F.unix_micros("timestamp")
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def _is_late(seconds: int, watermark: int | None) -> Column:
    """Whether the window of a row was closed before its batch."""
    if watermark is None:
        return F.lit(False)
    end = F.unix_micros(_start(seconds)) + seconds * 1_000_000
    return F.coalesce(end <= watermark, F.lit(False))


def _progress(spark: SparkSession, root: str, batch_id: int) -> dict:
    if batch_id < 0:
        return _NOTHING
    text = paths.read_text(spark, f"{root}/progress/{batch_id}")
    if text is None:
        raise ValueError(f"{root} lacks batch {batch_id}: it does not belong to this checkpoint")
    return json.loads(text)


def write_combined(batch: DataFrame, batch_id: int, root: str, watermark: str = WATERMARK) -> None:
    """Store what one batch adds to the four analyses; again, it replaces what it has stored."""
    spark = batch.sparkSession
    before = _progress(spark, root, batch_id - 1)
    closed = before["next_watermark"]
    position = [name for name in POSITION if name in batch.columns]
    rows = batch.select("ip", "timestamp", "url", "status_code", "method", *position).persist(StorageLevel.DISK_ONLY)
    try:
        late = [F.count_if(_is_late(c.seconds, closed)).alias(name) for name, c in COUNTED.items()]
        mark = F.unix_micros(F.max("timestamp") - F.expr(f"INTERVAL {watermark}"))
        seen = rows.agg(F.count("*").alias("input_rows"), mark.alias("mark"), *late).first()
        if seen["input_rows"]:
            entries = [
                F.struct(
                    F.lit(name).alias("analysis"),
                    _start(c.seconds).alias("window_start"),
                    (F.col(c.key) if c.key else F.lit(None).cast("string")).alias("key"),
                    _is_late(c.seconds, closed).alias("late"),
                )
                for name, c in COUNTED.items()
            ]
            counted = (
                rows.filter("timestamp IS NOT NULL").select(F.explode(F.array(*entries)).alias("e")).filter(~F.col("e.late"))
                .groupBy("e.analysis", "e.window_start", "e.key").agg(F.count("*").alias("request_count"))
            )
            # Sorted by analysis, so that a reader skips the row groups of the others.
            few = stamp(counted).hint("rebalance").sortWithinPartitions("analysis", "window_start")
            few.write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")
            failed = stamp(error_events(rows, keep=position)).hint("rebalance")
            failed.write.mode("overwrite").parquet(f"{root}/{ERRORS}/batch_id={batch_id}")
        else:
            for folder in ("counts", ERRORS):
                paths.delete(spark, f"{root}/{folder}/batch_id={batch_id}")
    finally:
        rows.unpersist()
    late_rows = {name: seen[name] for name in COUNTED}
    marks = [m for m in (closed, seen["mark"]) if m is not None]
    # Last: a batch without its progress does not count yet.
    progress = {
        "batch_id": batch_id,
        "input_rows": seen["input_rows"],
        "total_rows": before["total_rows"] + seen["input_rows"],
        "watermark": closed,
        "next_watermark": max(marks, default=None),
        "late_rows": late_rows,
        "total_late_rows": {name: n + before["total_late_rows"].get(name, 0) for name, n in late_rows.items()},
    }
    paths.write_text(spark, f"{root}/progress/{batch_id}", json.dumps(progress))


def to_combined(
    events: DataFrame,
    root: str,
    checkpoint: str,
    watermark: str = WATERMARK,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str = "combined",
) -> StreamingQuery:
    """Start one query that feeds the four analyses below ``root`` from one parse.

    Windows, watermark and results are those of ``start_all``: a row counts unless its window
    ended at or before the watermark, the latest time of earlier batches less the delay. Failed
    requests are kept however late, rows without a time are not counted. The order of batches
    decides what is late, so a root takes one query; another checkpoint is refused.
    """
    spark, root = events.sparkSession, root.rstrip("/")
    fed_by, resumed = paths.read_text(spark, f"{root}/_query_id"), query_of(spark, checkpoint)
    if fed_by and fed_by != resumed:
        raise ValueError(f"{root} belongs to query {fed_by}, the checkpoint to {resumed}")
    if not resumed and paths.exists(spark, f"{root}/progress/0"):
        raise ValueError(f"{root} already holds batches of another query")
    query = each_batch(
        events, lambda batch, batch_id: write_combined(batch, batch_id, root, watermark), checkpoint, "append", trigger, available_now, query_name
    )
    paths.write_text(spark, f"{root}/_query_id", query.id)
    return query


def _last(spark: SparkSession, root: str) -> int:
    return max(paths.numbered_files(spark, f"{root}/progress"), default=-1)


def read_combined(spark: SparkSession, root: str, analysis: str, since=None, until=None) -> DataFrame:
    """The rows of an analysis over all finished batches, of times from ``since`` and before ``until``.

    The columns are those of its table; ``processed_at`` is that of the last batch that added to a window.
    """
    root, table = root.rstrip("/"), table_for(analysis)
    if analysis not in COUNTED and analysis != ERRORS:
        raise ValueError(f"{analysis!r} is none of {[ERRORS, *COUNTED]}")
    counted = COUNTED.get(analysis)
    folder = f"{root}/counts" if counted else f"{root}/{ERRORS}"
    schema = _COUNTS if counted else StructType([*table.schema.fields, StructField("batch_id", table_for("top_ips").schema["request_count"].dataType)])
    if paths.exists(spark, folder):
        rows = spark.read.schema(schema).parquet(folder).filter(F.col("batch_id") <= _last(spark, root))
    else:
        rows = spark.createDataFrame([], schema)
    time = "window_start" if counted else table.time_col
    rows = rows if since is None else rows.filter(F.col(time) >= F.lit(since).cast(TimestampType()))
    rows = rows if until is None else rows.filter(F.col(time) < F.lit(until).cast(TimestampType()))
    if not counted:
        return rows.select(*table.schema.names)
    rows = rows.filter(F.col("analysis") == analysis).withColumnRenamed("window_start", counted.start)
    rows = rows.withColumnRenamed("key", counted.key) if counted.key else rows
    sums = rows.groupBy(*table.keys).agg(F.sum("request_count").alias("request_count"), F.max("processed_at").alias("processed_at"))
    return tagged(sums, counted.log_type).select(*table.schema.names)


PROGRESS_SCHEMA = "analysis string, batch_id long, input_rows long, total_rows long, watermark timestamp, late_rows long, total_late_rows long"


def combined_progress(spark: SparkSession, root: str) -> DataFrame:
    """One row per counting analysis as of the last finished batch: rows read and rows that came late.

    A late row is counted for each analysis whose window was closed. Totals are kept with every batch, so this reads
    one small file however long the stream has run, also after a restart; before the first batch there is no row.
    """
    root = root.rstrip("/")
    last = _progress(spark, root, _last(spark, root))
    # Of the batch itself: the watermark its rows were held against.
    rows = [
        (name, last["batch_id"], last["input_rows"], last["total_rows"], last["watermark"], last["late_rows"][name], last["total_late_rows"][name])
        for name in COUNTED
        if name in last["late_rows"]
    ]
    found = spark.createDataFrame(rows, PROGRESS_SCHEMA.replace("watermark timestamp", "watermark long"))
    return found.withColumn("watermark", F.timestamp_micros("watermark"))
