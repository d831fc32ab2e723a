"""Log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import strip
from ..schema import EVENTS


def read_log_files(
    spark: SparkSession,
    path: str | list[str],
    max_lines: int | None = None,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Non-blank lines of text files, stripped, as ``raw_log``.

    ``max_lines`` caps the number of lines of a batch read (0 or None: all); files
    have no order in Spark, so it does not mean the first ones. A stream takes the
    files of a folder as they arrive, oldest first, and can be paced with
    ``max_files_per_trigger``.
    """
    if streaming:
        if max_lines:
            raise ValueError("max_lines needs a batch read; pace a stream with max_files_per_trigger")
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read
    lines = reader.text(path).select(strip(F.col("value")).alias("raw_log")).filter(F.col("raw_log") != "")
    if not max_lines:
        return lines
    # The cap ends in one partition; what follows it gets all cores again.
    return lines.limit(max_lines).repartition(spark.sparkContext.defaultParallelism)


def read_events(
    spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parsed events stored as parquet, to run several analyses on one parse."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(EVENTS).parquet(path)
