"""Counts per minute, hour and day, kept up to date from what has changed.

Each level is a Parquet table whose folders hold one window of the level above. New counts of
minutes replace those of the same minutes and keys; only the hours that hold one of them are
added up again from their minutes, and only the days that hold one of those hours
from their hours. Spark's dynamic partition overwrite replaces just the touched folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import WATERMARK, windowed_count
from ..session import materialise
from ..store import paths
from .sinks import TRIGGER, each_batch

#: Levels from fine to coarse, and the window whose rows one folder holds.
LEVELS = {"minute": "hour", "hour": "day", "day": "month"}


def _part(level: str):
    return F.date_format(F.date_trunc(LEVELS[level], "window_start"), "yyyy-MM-dd-HH")


def _read(spark: SparkSession, root: str, level: str, like: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """The rows of a level, of some of its folders; none if there is no table yet."""
    if not paths.exists(spark, f"{root}/{level}"):
        return like.limit(0)
    schema = like.select("*", F.lit("").alias("part")).schema if "part" not in like.columns else like.schema
    # The folder's name is text, not a number or a date.
    rows = spark.read.schema(schema).parquet(f"{root}/{level}")
    rows = rows if parts is None else rows.filter(F.col("part").isin(parts))
    return rows.select(*like.columns)


def roll_up(changes: DataFrame, root: str, keys: Sequence[str] = ()) -> None:
    """Put new counts ``window_start`` (a minute), ``keys``, ``request_count`` in place and renew the windows above.

    Counts are whole, not increments: the same changes again change nothing, so a replayed
    batch or a second try after a failure is harmless. One writer at a time.
    """
    spark, keys = changes.sparkSession, list(keys)
    rows = materialise(changes.select("window_start", *keys, "request_count"))
    for level, above in LEVELS.items():
        new = rows.withColumn("part", _part(level))
        parts = [r["part"] for r in new.select("part").distinct().collect()]  # the touched folders
        if not parts:
            return
        old = _read(spark, root, level, rows, parts).alias("old")
        same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in ["window_start", *keys]]
        kept = old.join(rows.alias("new"), same, "left_anti")
        whole = materialise(kept.unionByName(rows).withColumn("part", _part(level)))
        (
            whole.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("part").parquet(f"{root}/{level}")
        )
        if above not in LEVELS:
            return
        # Only the windows above that hold a change, from all their parts: they lie in the folders just written.
        window = F.date_trunc(above, "window_start")
        touched = rows.select(window.alias("touched"), *[F.col(c).alias(f"touched_{c}") for c in keys]).distinct()
        on = [window.eqNullSafe(F.col("touched")), *[whole[c].eqNullSafe(F.col(f"touched_{c}")) for c in keys]]
        rows = materialise(
            whole.join(touched, on, "left_semi").groupBy(window.alias("window_start"), *keys).agg(F.sum("request_count").alias("request_count"))
        )


def read_rollup(spark: SparkSession, root: str, level: str, since=None, until=None) -> DataFrame:
    """The counts of a level (``minute``, ``hour``, ``day``), of windows from ``since`` and before ``until``."""
    rows = spark.read.parquet(f"{root}/{level}").drop("part")
    rows = rows if since is None else rows.filter(F.col("window_start") >= F.lit(since))
    return rows if until is None else rows.filter(F.col("window_start") < F.lit(until))


def to_rollups(
    events: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    watermark: str = WATERMARK,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str = "rollups",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Count a stream of events per minute and ``keys``, and keep all levels below ``root`` up to date."""
    minutes = windowed_count(events, keys, "1 minute", watermark)
    counts = minutes.select(F.col("time_window.start").alias("window_start"), *keys, "request_count")
    return each_batch(
        counts, lambda batch, _: roll_up(batch, root, keys), checkpoint, "update", trigger, available_now, query_name, state_partitions
    )
