"""Reports over parsed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import agents
from ..session import materialise
from .windows import windowed_count

TOP_K_SALTS = 32
SPIKE_BLOCK = 4096


def status_distribution(df: DataFrame) -> DataFrame:
    """Requests per status code and each code's share of all requests."""
    counts = df.groupBy("status_code").agg(F.count("*").alias("request_count"))
    total = counts.agg(F.sum("request_count")).scalar()
    return counts.withColumn("share", F.round(F.col("request_count") / total, 4))


def top_k(df: DataFrame, key: str, k: int = 10, width: str | None = None) -> DataFrame:
    """The ``k`` most frequent values of ``key``, overall or per window.

    Ties go to the smaller key, so exactly ``k`` rows rank. Overall, every task
    keeps its own best ``k`` and only those are merged. Per window, Spark cuts
    each window to ``k`` before the shuffle up to its group-limit threshold;
    beyond it the keys of a window are first ranked in salted parts.
    """
    best = [F.desc("request_count"), F.asc_nulls_first(key)]
    if width is None:
        counts = df.groupBy(key).agg(F.count("*").alias("request_count"))
        # At most k rows reach this window.
        return counts.orderBy(*best).limit(k).select(
            F.row_number().over(Window.orderBy(*best)).cast("bigint").alias("rank"), key, "request_count"
        )
    counts = windowed_count(df, (key,), width).select(
        F.col("time_window.start").alias("window_start"), key, "request_count"
    )
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold:
        salt = F.pmod(F.xxhash64(key), F.lit(TOP_K_SALTS))
        part = Window.partitionBy("window_start", "salt").orderBy(*best)
        counts = (
            counts.withColumn("salt", salt)
            .withColumn("part_rank", F.row_number().over(part))
            .filter(F.col("part_rank") <= k)
            .drop("salt", "part_rank")
        )
    rank = F.row_number().over(Window.partitionBy("window_start").orderBy(*best))
    return (
        counts.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("window_start", F.col("rank").cast("bigint").alias("rank"), key, "request_count")
    )


def heat_map(df: DataFrame) -> DataFrame:
    """Requests by weekday (Sunday is 1) and hour of the day."""
    return df.groupBy(
        F.dayofweek("timestamp").alias("weekday"), F.hour("timestamp").alias("hour_of_day")
    ).agg(F.count("*").alias("request_count"))


def agent_stats(df: DataFrame) -> DataFrame:
    """Requests by browser and device of the ``agent`` column."""
    # Classify each distinct agent text once instead of each request.
    agent_counts = df.groupBy("agent").agg(F.count("*").alias("n"))
    return agent_counts.groupBy(
        agents.browser(F.col("agent")).alias("browser"), agents.device(F.col("agent")).alias("device")
    ).agg(F.sum("n").alias("request_count"))


def product_stats(df: DataFrame) -> DataFrame:
    """Requests by product, platform and their versions, read from the ``agent`` column; null means none was sent."""
    agent_counts = df.groupBy("agent").agg(F.count("*").alias("n"))
    details = agent_counts.select("n", agents.agent_details(F.col("agent")).alias("d")).select("n", "d.*")
    return details.groupBy("product", "version", "platform", "platform_version", "bot").agg(F.sum("n").alias("request_count"))


def referrer_stats(df: DataFrame) -> DataFrame:
    """Requests by host of the ``referrer`` column; null means none was sent."""
    return df.groupBy(agents.referrer_host(F.col("referrer")).alias("referrer_host")).agg(
        F.count("*").alias("request_count")
    )


def _numbered(counts: DataFrame, ts_col: str) -> DataFrame:
    """Add ``position``, the row number in time order, without one global sort.

    Rows are numbered inside their ``block`` of time; only the sizes of the blocks,
    one row for ``SPIKE_BLOCK`` windows, are summed up in time order.
    """
    before = F.coalesce(
        F.sum("size").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = counts.groupBy("block").agg(F.count("*").alias("size")).select("block", before.alias("offset"))
    within = F.row_number().over(Window.partitionBy("block").orderBy(ts_col))
    return counts.join(offsets, "block").withColumn("position", F.col("offset") + within - 1)


def _filled(counts: DataFrame) -> DataFrame:
    """All windows from the first to the last, those without traffic with a count of 0."""
    start = F.unix_micros("window_start")
    first, last, step = counts.agg(F.min(start), F.max(start), F.max("step")).first()
    if step is None:
        return counts
    every = counts.sparkSession.range((last - first) // step + 1).select(
        F.timestamp_micros(F.lit(first) + F.col("id") * F.lit(step).cast("bigint")).alias("window_start")
    )
    block = F.floor(start / (F.lit(step).cast("bigint") * SPIKE_BLOCK))
    return every.join(counts.select("window_start", "request_count"), "window_start", "left").select(
        "window_start", F.coalesce("request_count", F.lit(0)).alias("request_count"), block.alias("block")
    )


def spikes(
    df: DataFrame,
    width: str = "1 hour",
    lookback: int = 24,
    z: float = 3.0,
    min_history: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Windows with more requests than the mean plus ``z`` deviations before them.

    The baseline is the ``lookback`` preceding windows that saw traffic, or with
    ``fill_gaps`` simply the preceding ones, where an outage counts as zero requests; a
    window with fewer than ``min_history`` (default: all) of them is not judged. Sums are
    exact decimals, so the verdict does not depend on the order of addition.
    """
    needed = lookback if min_history is None else min_history
    start, end = F.unix_micros("time_window.start"), F.unix_micros("time_window.end")
    windows = windowed_count(df, (), width)
    # Stored once: the numbering reads the counts twice, the events must not be.
    counts = materialise(
        windows.select(
            F.col("time_window.start").alias("window_start"),
            "request_count",
            F.floor(start / ((end - start) * SPIKE_BLOCK)).alias("block"),
            (end - start).alias("step"),
        )
    )
    if fill_gaps:
        counts = _filled(counts)

    # Chunks of consecutive windows, each with the last `lookback` of the chunk
    # before it, so that every frame is complete inside one chunk.
    length = max(SPIKE_BLOCK, lookback)
    chunk, place = F.floor(F.col("position") / length), F.col("position") % length
    homes = F.when(place >= length - lookback, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = _numbered(counts, "window_start").select(
        "window_start", "request_count", "position", chunk.alias("home"), F.explode(homes).alias("chunk")
    )
    frame = Window.partitionBy("chunk").orderBy("position").rowsBetween(-lookback, -1)
    n = F.count("*").over(frame)
    count = F.col("request_count").cast("decimal(18,0)")
    total, squares = F.sum(count).over(frame), F.sum(count * count).over(frame)
    judged = (
        spread.select("*", n.alias("n"), total.alias("s"), squares.alias("q"))
        .filter((F.col("chunk") == F.col("home")) & (F.col("n") >= max(needed, 1)))
        .withColumn("mean", F.col("s").cast("double") / F.col("n"))
        .withColumn(
            "deviation",
            F.sqrt((F.col("q") * F.col("n") - F.col("s") * F.col("s")).cast("double")) / F.col("n"),
        )
        .withColumn("threshold", F.col("mean") + F.lit(float(z)) * F.col("deviation"))
    )
    return judged.filter(F.col("request_count") > F.col("threshold")).select(
        "window_start",
        "request_count",
        F.round("mean", 6).alias("baseline"),
        F.round("threshold", 6).alias("threshold"),
    )


def percentile_name(p: float) -> str:
    return "p" + f"{100 * p:.10g}".replace(".", "_")


def value_percentiles(
    df: DataFrame,
    col: str,
    by: Sequence[str] = (),
    ps: Sequence[float] = (0.5, 0.95, 0.99),
    accuracy: int | None = None,
) -> DataFrame:
    """Percentiles of a numeric column, per group: one column ``p<percent>`` each.

    Exact with linear interpolation by default. Copies of a value are counted first, so
    a value that a third of the rows hold is one row from then on. The distinct values are
    range-partitioned and stored once; partition sums tell which partitions hold the
    wanted ranks, and only those are put in order, each in a task of its own.
    ``accuracy`` asks for the constant-size sketch instead, whose results are values of
    the column.
    """
    by, ps = list(by), list(ps)
    values = df.select(*by, F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    if accuracy is not None:
        return values.groupBy(*by).agg(
            *[F.percentile_approx("v", p, accuracy).alias(percentile_name(p)) for p in ps]
        )
    counted = values.groupBy(*by, "v").agg(F.count("*").alias("n"))
    # Partition numbers follow the order of the values within a group.
    counts = materialise(counted.repartitionByRange(*by, "v").withColumn("part", F.spark_partition_id()))

    # One row per partition and group that meet.
    sums = counts.groupBy(*by, "part").agg(F.sum("n").alias("size"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sums.select(*by, "part", "size", before.alias("before"), F.sum("size").over(group).alias("total"))

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("total") - 1)

    held = F.lit(False)
    for rank in [edge(position(p)) for p in ps for edge in (F.floor, F.ceil)]:
        held = held | ((rank >= F.col("before")) & (rank < F.col("before") + F.col("size")))
    key = [*by, "part"]
    targets = placed.filter(held).select(*[F.col(name).alias(f"_t_{name}") for name in key], "before", "total")
    chosen = counts.join(targets, [F.col(name).eqNullSafe(F.col(f"_t_{name}")) for name in key])
    running = Window.partitionBy(*key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = chosen.withColumn("end", F.col("before") + F.sum("n").over(running)).withColumn(
        "start", F.col("end") - F.col("n")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("v")))

    picks = []
    for i, p in enumerate(ps):
        picks += [at(F.floor(position(p))).alias(f"_lo{i}"), at(F.ceil(position(p))).alias(f"_hi{i}")]
    found = ranked.groupBy(*by).agg(F.max("total").alias("total"), *picks)
    if not by:
        found = found.filter("total IS NOT NULL")

    def interpolated(i: int, p: float) -> Column:
        low, high, fraction = F.col(f"_lo{i}"), F.col(f"_hi{i}"), position(p) - F.floor(position(p))
        return F.when(low == high, low).otherwise(low * (1 - fraction) + high * fraction)

    return found.select(*by, *[interpolated(i, p).alias(percentile_name(p)) for i, p in enumerate(ps)])
