"""Result tables as versioned folders of files.

Layout below the root of a store::

    <table>/batches/batch_id=<n>/        rows of one batch
    <table>/refused/batch_id=<n>/        rows of the batch with a value that does not fit, as JSON
    <table>/compact/upto=<m>/dt=<day>/   newest rows of the days that batches up to m have touched
    <table>/manifests/<m>                for each day, the upto of its live folder; the batch numbers
                                         up to m that are not folded in
    <table>/claims/<n>                   a batch number that a writer has taken
    <table>/_format, <table>/_query_id   file format; the stream that feeds the table

A batch is written with overwrite into its own folder, so a replay replaces it.
A folder counts once it holds ``_SUCCESS``, a compaction once it has its manifest.
"""

from __future__ import annotations

import json
import logging
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType

from ..functions.keys import stamp
from ..operators.tables import latest_per_key, retain
from ..schema import TABLES, ResultTable, table_for
from . import paths

FILE_FORMATS = ("parquet", "orc", "json")
NO_BATCH = -1
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
OPEN = "open"

log = logging.getLogger(__name__)


class WriteResult(NamedTuple):
    """Rows written, and rows refused because a value does not fit its column."""

    written: int
    failed: int


class Manifest(NamedTuple):
    """A compaction: its last batch, where each day lives, and ranges of earlier batches it has not folded in."""

    upto: int = NO_BATCH
    live: dict[str, int] = {}
    open: list[list[int]] = []

    def folded(self, number: int) -> bool:
        return number <= self.upto and not any(a <= number <= b for a, b in self.open)

    def text(self) -> str:
        return json.dumps({**self.live, OPEN: self.open} if self.open else self.live)


def table_path(root: str, analysis: str) -> str:
    return f"{root.rstrip('/')}/{table_for(analysis).name}"


def _compacts(root: str, analysis: str) -> str:
    return f"{table_path(root, analysis)}/compact"


def _batches(root: str, analysis: str) -> str:
    return f"{table_path(root, analysis)}/batches"


def _refused(root: str, analysis: str) -> str:
    return f"{table_path(root, analysis)}/refused"


def _manifests(root: str, analysis: str) -> str:
    return f"{table_path(root, analysis)}/manifests"


def _manifest(spark: SparkSession, root: str, analysis: str) -> Manifest | None:
    """The newest compaction. One entry per day."""
    done = paths.numbered_files(spark, _manifests(root, analysis))
    if not done:
        return None
    live = json.loads(paths.read_text(spark, f"{_manifests(root, analysis)}/{done[-1]}"))
    return Manifest(done[-1], live, live.pop(OPEN, []))


def _without(ranges: list[list[int]], numbers: list[int]) -> list[list[int]]:
    """Ranges of batch numbers without ``numbers``."""
    for n in numbers:
        ranges = [r for a, b in ranges for r in ([[a, n - 1], [n + 1, b]] if a <= n <= b else [[a, b]])]
    return [[a, b] for a, b in ranges if a <= b]


def _table_format(spark: SparkSession, root: str, analysis: str, fmt: str | None) -> str:
    """The table's file format: the recorded one, which a given one must equal."""
    recorded = paths.read_text(spark, f"{table_path(root, analysis)}/_format")
    if fmt is not None and fmt not in FILE_FORMATS:
        raise ValueError(f"format must be one of {FILE_FORMATS}, not {fmt!r}")
    if recorded and fmt and fmt != recorded:
        raise ValueError(f"table {analysis} is stored as {recorded}, not {fmt}")
    return recorded or fmt or "parquet"


def _owner_file(root: str, analysis: str) -> str:
    return f"{table_path(root, analysis)}/_query_id"


def owner(spark: SparkSession, root: str, analysis: str) -> str | None:
    """Id of the stream that feeds the table, None if it is not fed by one."""
    return paths.read_text(spark, _owner_file(root, analysis))


def set_owner(spark: SparkSession, root: str, analysis: str, query_id: str) -> None:
    paths.write_text(spark, _owner_file(root, analysis), query_id)


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """Create the tables that do not exist yet; returns their analyses."""
    created = []
    for analysis in TABLES:
        if _manifest(spark, root, analysis) is None:
            paths.write_text(spark, f"{_manifests(root, analysis)}/{NO_BATCH}", "{}")
            created.append(analysis)
    return created


def drop_table(spark: SparkSession, root: str, analysis: str) -> bool:
    """Remove a table; False if it does not exist."""
    return paths.delete(spark, table_path(root, analysis))


def _stored_schema(table: ResultTable) -> StructType:
    return StructType(list(table.schema.fields)).add("batch_id", LongType())


def last_batch(spark: SparkSession, root: str, analysis: str) -> int:
    """Number of the newest finished batch, -1 before the first."""
    known = paths.numbered(spark, _batches(root, analysis), "batch_id")
    known += paths.numbered_files(spark, _manifests(root, analysis))
    return max(known, default=NO_BATCH)


def write_batch(
    df: DataFrame, analysis: str, root: str, batch_id: int, mode: str = "overwrite", fmt: str | None = None
) -> WriteResult:
    """Write one batch in a single execution of ``df``.

    Columns are cast to the table's types. Rows with a value that does not fit are
    counted, logged and kept beside the table (:func:`read_refused`), which costs a
    second execution for such a batch only. A batch without rows leaves no folder.
    """
    spark = df.sparkSession
    table = table_for(analysis)
    fmt = _table_format(spark, root, analysis, fmt)
    stamped = stamp(df)
    fits = F.lit(True)
    for field in table.schema.fields:
        source = F.col(field.name)
        if stamped.schema[field.name].dataType != field.dataType:
            fits = fits & (source.isNull() | source.try_cast(field.dataType).isNotNull())
    outcome = Observation()
    checked = stamped.withColumn("_fits", fits).observe(
        outcome, F.count_if("_fits").alias("written"), F.count_if(~F.col("_fits")).alias("failed")
    )
    rows = checked.filter("_fits").select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )
    folder = f"{_batches(root, analysis)}/batch_id={batch_id}"
    # One file per task would leave as many small files as there are state partitions.
    rows.hint("rebalance").write.mode(mode).format(fmt).save(folder)
    counts = outcome.get
    result = WriteResult(counts["written"], counts["failed"])
    if result.written == 0:
        paths.delete(spark, folder)
    else:
        paths.write_text(spark, f"{table_path(root, analysis)}/_format", fmt)
    refused = f"{_refused(root, analysis)}/batch_id={batch_id}"
    if result.failed:
        log.warning("%s: %d rows of batch %d do not fit the table", analysis, result.failed, batch_id)
        misfits = stamped.filter(~fits).select(F.to_json(F.struct("*")).alias("document"))
        misfits.write.mode("overwrite").text(refused)
    elif mode == "overwrite":
        paths.delete(spark, refused)
    return result


def read_refused(spark: SparkSession, analysis: str, root: str) -> DataFrame:
    """Rows that :func:`write_batch` could not store: ``document`` (JSON) and ``batch_id``."""
    if not paths.numbered(spark, _refused(root, analysis), "batch_id"):
        return spark.createDataFrame([], "document string, batch_id bigint")
    return spark.read.schema("document string, batch_id bigint").text(_refused(root, analysis))


def append_rows(df: DataFrame, analysis: str, root: str, fmt: str | None = None) -> WriteResult:
    """Add rows to a table that no stream feeds.

    In a keyed table they replace older rows of the same key. The batch number is
    claimed by creating a file that must not exist, so of two writers each gets its
    own (as far as the file system creates files atomically). A number whose write
    failed stays unused.
    """
    spark = df.sparkSession
    if owner(spark, root, analysis):
        raise ValueError(f"{analysis} is fed by a stream; its batches are numbered by that stream")
    claims = f"{table_path(root, analysis)}/claims"
    taken = paths.numbered(spark, _batches(root, analysis), "batch_id", finished=False)
    number = max([last_batch(spark, root, analysis), *taken, *paths.numbered_files(spark, claims)]) + 1
    while not paths.create_new(spark, f"{claims}/{number}"):
        number += 1
    return write_batch(df, analysis, root, number, mode="error", fmt=fmt)


def _waiting(spark: SparkSession, root: str, analysis: str, done: Manifest) -> list[int]:
    """Finished batches that are not folded in, also those that finished after later ones."""
    return [n for n in paths.numbered(spark, _batches(root, analysis), "batch_id") if not done.folded(n)]


def _batch_rows(spark: SparkSession, root: str, analysis: str, numbers: list[int], fmt: str | None) -> DataFrame | None:
    """Rows of the batches ``numbers``, with their number."""
    schema = _stored_schema(table_for(analysis))
    if not numbers:
        return None
    parent = _batches(root, analysis)
    reader = spark.read.schema(schema).format(_table_format(spark, root, analysis, fmt)).option("basePath", parent)
    return reader.load([f"{parent}/batch_id={n}" for n in numbers]).select(*schema.names)


def _day_rows(spark: SparkSession, root: str, analysis: str, live: dict[str, int]) -> DataFrame | None:
    """Compacted rows of the days in ``live``, with ``dt`` and the number of the batch they came with."""
    table, parent = table_for(analysis), _compacts(root, analysis)
    if not live:
        return None
    schema = _stored_schema(table).add("upto", LongType()).add("dt", DateType())
    rows = spark.read.schema(schema).option("basePath", parent).parquet(*[f"{parent}/upto={n}/dt={day}" for day, n in sorted(live.items())])
    # Files of earlier versions do not hold the number.
    return rows.select(*table.schema.names, F.coalesce("batch_id", "upto").alias("batch_id"), "dt")


def _newest(rows: DataFrame, table: ResultTable) -> DataFrame:
    if not table.keys:
        return rows
    # Within one batch the greatest count wins: counts of a window only grow.
    return latest_per_key(rows, table.keys, [F.desc("batch_id"), F.desc("request_count"), F.desc("processed_at")])


def _as_date(day: date | str | None) -> date | None:
    return date.fromisoformat(day) if isinstance(day, str) else day


def read_latest(
    spark: SparkSession,
    analysis: str,
    root: str,
    upto: int | None = None,
    fmt: str | None = None,
    since: date | str | None = None,
    until: date | str | None = None,
) -> DataFrame:
    """The current rows of a table: of each key only the newest version.

    ``since`` and ``until`` (days, inclusive) limit the rows by the table's time; of the
    compacted days only their folders are listed and read. Compacted keys are unique, so
    only rows of later batches are ranked, and compacted rows just give way to them. If a
    batch has finished after a later one was folded in, all rows are ranked.
    """
    table, names = table_for(analysis), table_for(analysis).schema.names
    since, until = _as_date(since), _as_date(until)
    done = _manifest(spark, root, analysis) or Manifest()
    live = done.live
    day = F.to_date(table.time_col)
    if since or until:
        within = lambda d: d != NO_DAY and (not since or d >= since.isoformat()) and (not until or d <= until.isoformat())
        live = {d: n for d, n in live.items() if within(d)}

    def limited(rows: DataFrame, column: Column) -> DataFrame:
        if since:
            rows = rows.filter(column >= F.lit(since))
        return rows.filter(column <= F.lit(until)) if until else rows

    old = _day_rows(spark, root, analysis, live)
    numbers = [n for n in _waiting(spark, root, analysis, done) if upto is None or n <= upto]
    new = _batch_rows(spark, root, analysis, numbers, fmt)
    if old is not None:
        old = limited(old, F.col("dt")).select(*names, "batch_id")
    if new is not None:
        new = limited(new, day)
        if old is not None and numbers[0] < done.upto:
            new, old = old.unionByName(new), None
        new = _newest(new, table).select(*names)
    if old is not None:
        old = old.select(*names)
    if old is None or new is None:
        found = old if new is None else new
        return spark.createDataFrame([], table.schema) if found is None else found
    if table.keys:
        replaced = new.select(*[F.col(k).alias(f"_new_{k}") for k in table.keys])
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in table.keys]
        old = old.join(replaced, same, "left_anti")
    return old.unionByName(new)


def compact(
    spark: SparkSession,
    analysis: str,
    root: str,
    retain_days: int | None = None,
    as_of: datetime | date | str | None = None,
    fmt: str | None = None,
) -> int:
    """Fold all finished batches into day folders; only days they touch are written anew.

    Returns the number of the compaction: that of the last batch folded in, or the next one
    if only batches below the last compaction were left. Batches that are not finished yet are
    noted, stay readable once they are, and are folded in next time. ``retain_days`` drops older
    rows of the rewritten days on the way, and whole old days. Readers keep working: a
    compaction counts once its manifest is there, and the old folders stay until
    :func:`vacuum`. A key lies in one day, as keys hold the time of their window.
    """
    table = table_for(analysis)
    done = _manifest(spark, root, analysis) or Manifest()
    live, waiting = done.live, _waiting(spark, root, analysis, done)
    number = max([done.upto, *waiting])
    new = _batch_rows(spark, root, analysis, waiting, fmt)
    if new is not None:
        only_late = number == done.upto
        if only_late:  # the folder of that number is live
            number += 1
        day = F.coalesce(F.to_date(table.time_col).cast("string"), F.lit(NO_DAY))
        touched = {r["day"] for r in new.select(day.alias("day")).distinct().collect()}  # days, not rows
        old = _day_rows(spark, root, analysis, {d: n for d, n in live.items() if d in touched})
        rows = new if old is None else old.select(*new.columns).unionByName(new)
        rows = _newest(rows, table).select(*table.schema.names, "batch_id")
        if retain_days is not None:
            rows = retain(rows, table.time_col, retain_days, as_of)
        target = f"{_compacts(root, analysis)}/upto={number}"
        # Rebalancing splits a busy day over several tasks and files.
        by_day = rows.withColumn("dt", F.to_date(table.time_col)).hint("rebalance", "dt")
        by_day.write.mode("overwrite").partitionBy("dt").parquet(target)
        written = set(paths.days(spark, target))
        live = {d: n for d, n in live.items() if d not in touched} | {d: number for d in written}
        # A stream finishes its batches in order; a number without a folder had no rows.
        in_order = owner(spark, root, analysis) and not only_late
        left = _without(done.open if in_order else [*done.open, [done.upto + 1, number]], waiting)
        paths.write_text(spark, f"{_manifests(root, analysis)}/{number}", Manifest(number, live, left).text())
    if retain_days is not None:
        expire(spark, analysis, root, retain_days, as_of)
    return number


def expire(
    spark: SparkSession, analysis: str, root: str, days: int, as_of: datetime | date | str | None = None
) -> int:
    """Delete whole days older than ``days`` days from the compacted table.

    Only folders are removed, no data is read. Returns their number.
    """
    newest = _manifest(spark, root, analysis)
    if newest is None:
        return 0
    number, live, left = newest
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    oldest = spark.range(1).select(F.to_date(moment - F.make_dt_interval(F.lit(days))).alias("d")).first()["d"]
    old = [day for day in live if day != NO_DAY and day < oldest.isoformat()]
    if old:
        # First out of sight, then away.
        paths.write_text(spark, f"{_manifests(root, analysis)}/{number}", Manifest(number, {d: n for d, n in live.items() if d not in old}, left).text())
    for day in old:
        paths.delete(spark, f"{_compacts(root, analysis)}/upto={live[day]}/dt={day}")
    return len(old)


def vacuum(spark: SparkSession, analysis: str, root: str) -> int:
    """Delete folders that compaction has replaced; returns their number."""
    newest = _manifest(spark, root, analysis)
    if newest is None:
        return 0
    number, live, _ = newest
    old = []
    for upto in paths.numbered(spark, _compacts(root, analysis), "upto", finished=False):
        folder = f"{_compacts(root, analysis)}/upto={upto}"
        days = paths.days(spark, folder)
        dead = [day for day in days if live.get(day) != upto]
        # A folder beyond the manifest may belong to a compaction that still runs.
        if upto <= number:
            old += [folder] if len(dead) == len(days) else [f"{folder}/dt={day}" for day in dead]
    old += [
        f"{_batches(root, analysis)}/batch_id={n}"
        for n in paths.numbered(spark, _batches(root, analysis), "batch_id")
        if newest.folded(n)
    ]
    for n in paths.numbered_files(spark, _manifests(root, analysis))[:-1]:
        paths.delete(spark, f"{_manifests(root, analysis)}/{n}")
    return sum(paths.delete(spark, folder) for folder in old)
