"""Raw log lines to typed events, and the lines that could not be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clf
from ..schema import EVENTS

NO_MATCH = "no_match"
BAD_TIMESTAMP = "bad_timestamp"


def _scan_lines(
    df: DataFrame, col: str, keep_offset: bool, keep: Sequence[str], trailer: bool = False
) -> DataFrame:
    """Lines with their fields, time and reject cause.

    The fields go through a one-row ``inline``: a filter on a generated column
    stays above the generator, so the regex runs once per line. A plain projection
    would be copied into every filter that is pushed below it.
    """
    arrival = "kafka_timestamp" if "kafka_timestamp" in df.columns else F.lit(None).cast("timestamp")
    lines = df.select(
        *keep,
        F.col(arrival) if isinstance(arrival, str) else arrival.alias("kafka_timestamp"),
        F.col(col).alias("raw_log"),
        clf.split_line(F.col(col), trailer).alias("_line"),
    )
    fields = F.col("_line")
    parsed = F.struct(
        fields.alias("_fields"),
        clf.parse_clf_ts(clf.time_text(fields), keep_offset).alias("timestamp"),
    )
    scanned = lines.select(*keep, "kafka_timestamp", "raw_log", F.inline(F.array(parsed)))
    cause = F.when(F.coalesce(F.col("_fields")[clf.IP], F.lit("")) == "", NO_MATCH).when(
        F.col("timestamp").isNull(), BAD_TIMESTAMP
    )
    return scanned.withColumn("cause", cause)


def add_buckets(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Add the text columns ``hour`` and ``minute``."""
    return df.withColumns(
        {"hour": clf.hour_bucket(F.col(ts_col)), "minute": clf.minute_bucket(F.col(ts_col))}
    )


def parse_clf(
    df: DataFrame,
    col: str = "raw_log",
    on_bad_ts: str = "reject",
    keep_offset: bool = True,
    combined: bool = False,
    identity: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse log lines, batch or streaming.

    Lines that do not match are left out; :func:`rejects` returns them.

    on_bad_ts
        ``"reject"`` leaves lines with an unreadable time out as well,
        ``"null"`` keeps them with a null time, ``"now"`` stamps them with the
        current time. Under a watermark ``"now"`` makes later rows look late.
    keep_offset
        Honour the UTC offset of the line; False reads wall-clock time.
    combined
        Add ``referrer`` and ``agent`` from the two trailing quoted fields.
    identity
        Add ``remote_log_name`` and ``remote_user``.
    keep
        Further columns of ``df`` to carry along.
    """
    if on_bad_ts not in ("reject", "null", "now"):
        raise ValueError(f"on_bad_ts must be reject, null or now, not {on_bad_ts!r}")
    scanned = _scan_lines(df, col, keep_offset, keep, trailer=combined)
    if on_bad_ts == "reject":
        scanned = scanned.filter(F.col("cause").isNull())
    else:
        scanned = scanned.filter(F.col("cause").isNull() | (F.col("cause") == BAD_TIMESTAMP))
    if on_bad_ts == "now":
        scanned = scanned.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()))

    fields = F.col("_fields")
    extra = []
    if identity:
        extra += [fields[clf.LOG_NAME].alias("remote_log_name"), fields[clf.USER].alias("remote_user")]
    if combined:
        extra += [clf.trailing_field(fields, 1).alias("referrer"), clf.trailing_field(fields, 2).alias("agent")]
    events = scanned.select(
        fields[clf.IP].alias("ip"),
        "timestamp",
        clf.request_word(fields, clf.METHOD).alias("method"),
        clf.request_word(fields, clf.URL).alias("url"),
        clf.request_word(fields, clf.PROTOCOL).alias("protocol"),
        fields[clf.STATUS].try_cast("int").alias("status_code"),
        clf.size_bytes(fields[clf.SIZE]).alias("content_size"),
        "kafka_timestamp",
        "raw_log",
        *extra,
        *keep,
    )
    added = [name for name in events.columns if name not in EVENTS.names]
    return add_buckets(events).select(*EVENTS.names, *added)


def rejects(df: DataFrame, col: str = "raw_log", keep: Sequence[str] = ()) -> DataFrame:
    """The lines :func:`parse_clf` leaves out, with the cause of each."""
    scanned = _scan_lines(df, col, True, keep)
    return scanned.filter(F.col("cause").isNotNull()).select(*keep, "raw_log", "kafka_timestamp", "cause")


def reject_fields(df: DataFrame, col: str = "raw_log", keep: Sequence[str] = ()) -> DataFrame:
    """Rejected lines with the broken ``field`` and its ``position`` in the line, from 1.

    Lines are read from their start; only those already found to be rejects are looked at closer. An
    unreadable time is ``time`` at its first character; a line that is sound up to a field is broken where it ends.
    A line that only lacks a field in a place where parsing would skip words before the client is named by its first words.
    """
    scanned = _scan_lines(df, col, True, keep).filter(F.col("cause").isNotNull())
    field, position = clf.broken_field(F.col("raw_log"))
    bad_time = F.col("cause") == BAD_TIMESTAMP
    at = F.position(F.concat(F.lit("["), clf.time_text(F.col("_fields")), F.lit("]")), F.col("raw_log"))
    return scanned.select(
        *keep, "raw_log", "cause",
        F.when(bad_time, "time").otherwise(field).alias("field"),
        F.when(bad_time, at + 1).otherwise(position).cast("bigint").alias("position"),
    )


def reject_counts(df: DataFrame, col: str = "raw_log") -> DataFrame:
    """Number of rejected lines by cause."""
    return rejects(df, col).groupBy("cause").agg(F.count("*").alias("line_count"))


def format_clf(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events back to log lines: the inverse of :func:`parse_clf` to whole seconds."""
    names = ("ip", "timestamp", "method", "url", "protocol", "status_code", "content_size")
    return df.select(*keep, clf.clf_line(*[F.col(name) for name in names]).alias("raw_log"))
