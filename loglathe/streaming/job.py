"""The four analyses as one streaming job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.errors import error_events
from ..operators.parse import rejects
from ..operators.windows import ip_activity, traffic, url_activity
from ..schema import TABLES
from ..store import read_refused
from .sinks import TRIGGER, to_connector, to_table

# The names of the analyses, also their query names.
ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "error_logs": error_events,
    "traffic_by_minute": traffic,
    "top_ips": ip_activity,
    "url_analysis": url_activity,
}


def analysis_frames(
    events: DataFrame, analyses: Iterable[str] = tuple(ANALYSES), lines: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The chosen analyses over parsed events, batch or streaming.

    With the raw ``lines`` also ``rejects``, the lines that parsing leaves out.
    """
    position = [name for name in ("kafka_partition", "kafka_offset") if name in events.columns]
    frames = {
        name: error_events(events, keep=position) if name == "error_logs" else ANALYSES[name](events)
        for name in analyses
    }
    if lines is not None:
        frames["rejects"] = rejects(lines)
    return frames


def start_all(
    events: DataFrame,
    root: str,
    checkpoint_root: str,
    analyses: Iterable[str] = tuple(ANALYSES),
    trigger: str = TRIGGER,
    available_now: bool = False,
    fmt: str | None = None,
    state_partitions: int | None = None,
    lines: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """Start one query per analysis, each with its own checkpoint below the root.

    ``lines``, the raw lines of the same source, adds a query that stores the rejects.

    If one cannot start, those already running are stopped again.
    """
    started: dict[str, StreamingQuery] = {}
    try:
        for name, frame in analysis_frames(events, analyses, lines).items():
            started[name] = to_table(
                frame,
                name,
                root,
                f"{checkpoint_root.rstrip('/')}/{name}",
                trigger=trigger,
                available_now=available_now,
                fmt=fmt,
                state_partitions=state_partitions,
            )
    except Exception:
        stop(started.values())
        raise
    return started


def start_all_connector(
    events: DataFrame,
    fmt: str,
    options: Callable[[str], Mapping[str, str]],
    checkpoint_root: str,
    analyses: Iterable[str] = tuple(ANALYSES),
    **settings,
) -> dict[str, StreamingQuery]:
    """As :func:`start_all`, into a data source; ``options`` gives those of an analysis."""
    started: dict[str, StreamingQuery] = {}
    try:
        for name, frame in analysis_frames(events, analyses).items():
            checkpoint = f"{checkpoint_root.rstrip('/')}/{name}"
            started[name] = to_connector(frame, name, fmt, options(name), checkpoint, **settings)
    except Exception:
        stop(started.values())
        raise
    return started


def wait_all(spark: SparkSession, queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until all queries have ended; if any fails, stop the others and raise."""
    while True:
        for query in queries.values():
            if query.exception() is not None:
                stop(queries.values())
                raise query.exception()
        running = [query for query in queries.values() if query.isActive]
        if not running:
            return
        try:
            # Returns as soon as any query of the session ends, not only the first.
            spark.streams.awaitAnyTermination(5)
        except StreamingQueryException:
            # Maybe of a query not waited for here; ours are looked at above.
            pass
        finally:
            spark.streams.resetTerminated()


def stop(queries: Iterable[StreamingQuery]) -> int:
    """Stop the given queries; returns how many were running."""
    running = [query for query in queries if query.isActive]
    for query in running:
        query.stop()
    return len(running)


def stop_all(spark: SparkSession) -> int:
    """Stop every query of the session; returns how many were running."""
    return stop(spark.streams.active)


STATUS_SCHEMA = "name string, active boolean, batch_id long, input_rows long, late_groups long, refused_rows long, message string"


def status(spark: SparkSession, queries: Sequence[StreamingQuery] | None = None, root: str | None = None) -> DataFrame:
    """One row per query, by default of all that run.

    ``input_rows`` is that of the last batch. ``late_groups`` counts, over the recent
    batches, what came in after its window was closed: Spark drops late rows after it
    has combined them per task, window and key, so it is a number of such groups, at
    most that of the rows. ``refused_rows`` are those kept beside the table below ``root``.
    """
    rows = []
    for query in spark.streams.active if queries is None else queries:
        last, recent = query.lastProgress, query.recentProgress
        late = sum(
            operator["numRowsDroppedByWatermark"] for progress in recent for operator in progress["stateOperators"]
        )
        rows.append(
            (
                query.name,
                query.isActive,
                last["batchId"] if last else None,
                last["numInputRows"] if last else None,
                late,
                read_refused(spark, query.name, root).count() if root and query.name in TABLES else None,
                str(query.exception() or query.status["message"]),
            )
        )
    return spark.createDataFrame(rows, STATUS_SCHEMA)
