"""Message keys, document ids and ingestion stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import table_for

# The leading address of a line and the key of lines without one.
LEADING_IPV4 = r"^(\d+\.\d+\.\d+\.\d+)"
UNKNOWN_KEY = "unknown"

# The characters a log shipper strips from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def message_key(line: Column, given: Column | None = None, host: bool = False) -> Column:
    """Topic key of a line: the caller's, else its leading IPv4, else ``unknown``.

    ``host=True`` takes the first word instead of only an IPv4, which spreads
    lines of named hosts over the partitions.
    """
    pattern = r"^(\S+)" if host else LEADING_IPV4
    found = F.nullif(F.regexp_extract(strip(line), pattern, 1), F.lit(""))
    choices = [] if given is None else [F.nullif(given, F.lit(""))]
    return F.coalesce(*choices, found, F.lit(UNKNOWN_KEY))


def with_message_key(df: DataFrame, line: str = "raw_log", key: str | None = None, host: bool = False) -> DataFrame:
    """Rows in the layout of a topic: ``key`` and stripped ``value``."""
    given = None if key is None else F.col(key)
    return df.select(message_key(F.col(line), given, host).alias("key"), strip(F.col(line)).alias("value"))


def stamp(df: DataFrame) -> DataFrame:
    """Add ``processed_at``, one value per batch."""
    return df.withColumn("processed_at", F.current_timestamp())


def document_id(df: DataFrame, analysis: str, source_position: Sequence[str] = ("kafka_partition", "kafka_offset")) -> Column:
    """A stable id of a result row, so that writing it again replaces it.

    Keyed tables use their key. Other rows use the whole row plus, where the
    frame carries them, the columns of its position in the source, which keeps
    two identical requests apart.
    """
    table = table_for(analysis)
    position = [name for name in source_position if name in df.columns]
    row = [name for name in table.schema.names if name != "processed_at" and name in df.columns]
    names = list(table.keys) or row + position
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
