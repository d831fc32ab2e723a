"""Traffic spikes on a stream."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructField, StructType, TimestampType

from ..operators.windows import WATERMARK, windowed_count


class _Ring(StatefulProcessor):
    """The last counts of one series; judges each closed window against those before it.

    State is one row: up to ``lookback`` counts, the oldest first, and the start of the
    last window. With ``forget`` a timer clears it when no window came for so long.
    """

    def __init__(self, names: Sequence[str], lookback: int, needed: int, z: float, fill_gaps: bool, forget_micros: int | None):
        self.names, self.lookback, self.needed, self.z, self.fill_gaps, self.forget = list(names), lookback, needed, z, fill_gaps, forget_micros

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", "counts array<bigint>, last bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        counts, last = self.state.get() if self.state.exists() else ([], None)
        counts = list(counts)
        # One row a window; a batch may close several, in any order.
        for row in sorted(rows, key=lambda r: r["start"]):
            start, step, count = row["start"], row["step"], row["request_count"]
            if last is not None and self.forget is not None and start - last > self.forget:
                counts = []
            elif last is not None and self.fill_gaps:
                counts += [0] * min((start - last) // step - 1, self.lookback)
            counts = counts[-self.lookback :]
            n = len(counts)
            if n >= max(self.needed, 1):
                total, squares = sum(counts), sum(c * c for c in counts)
                mean, deviation = total / n, math.sqrt(float(squares * n - total * total)) / n
                threshold = mean + self.z * deviation
                if count > threshold:
                    found = dict(zip(self.names, key, strict=True), start=start, request_count=count, mean=mean, threshold=threshold)
                    yield Row(**found)
            counts, last = [*counts, count][-self.lookback :], start
        self.state.update((counts, last))
        if self.forget is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(-(-(last + self.forget) // 1000) + 1)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _micros(width: str) -> int:
    """A length such as ``10 minutes`` in microseconds."""
    number, unit = width.split()
    return int(dt.timedelta(**{unit.rstrip("s") + "s": float(number)}) / dt.timedelta(microseconds=1))


def live_spikes(
    events: DataFrame,
    width: str = "1 hour",
    lookback: int = 24,
    z: float = 3.0,
    min_history: int | None = None,
    fill_gaps: bool = False,
    by: Sequence[str] = (),
    watermark: str = WATERMARK,
    forget: str | None = None,
) -> DataFrame:
    """Spikes of a stream as soon as the watermark has passed a window: what ``spikes`` finds in a batch.

    Columns are those of ``by``, ``window_start, request_count, baseline, threshold``. Each closed
    window comes once and in order, so each series keeps only its last ``lookback`` counts, in
    keyed state; restarts go on from it. With ``by`` every value is a series of its own, spread
    over the tasks. ``forget`` drops the history of a series that had no window for so long, so
    that clients that never return cost nothing; by default it is kept for ever. Windows that
    the watermark has not passed are not judged yet. Needs the RocksDB state store
    (``build_session`` sets it) and append mode.
    """
    counts = windowed_count(events, by, width, watermark)
    start, end = F.unix_micros("time_window.start"), F.unix_micros("time_window.end")
    names = [f"by_{i}" for i in range(len(by))]
    series = counts.select(
        *[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.lit(0).alias("all"),
        start.alias("start"), (end - start).alias("step"), "request_count",
    )
    key = names or ["all"]
    schema = StructType(
        [StructField(n, series.schema[n].dataType) for n in key]
        + list(StructType.fromDDL("start bigint, request_count bigint, mean double, threshold double"))
    )
    needed = lookback if min_history is None else min_history
    ring = _Ring(key, lookback, needed, float(z), fill_gaps, _micros(forget) if forget else None)
    found = series.groupBy(*key).transformWithState(ring, schema, "Append", "EventTime" if forget else "None")
    return found.select(
        *[F.col(n).alias(c) for c, n in zip(by, names, strict=True)],
        F.timestamp_micros("start").cast(TimestampType()).alias("window_start"),
        "request_count",
        F.round("mean", 6).alias("baseline"),
        F.round("threshold", 6).alias("threshold"),
    )
