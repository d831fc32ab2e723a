"""Mergeable summaries of each time window, stored batch by batch.

A micro-batch leaves one row for each window and group it holds: the number of requests, a
heavy-hitter sketch of each key and a quantile sketch of each number. Sketches of any batches,
windows and groups can be merged, so every span of time is answered from small rows
alone, and late events merely add a row to an old window: nothing is dropped, and the
stream keeps no state. A replayed batch replaces its own folder.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.reports import percentile_name, top_k
from ..session import materialise
from ..store import paths
from .sinks import TRIGGER, each_batch, query_of

#: Keys a heavy-hitter sketch tracks, and the size of a quantile sketch.
TRACKED, ACCURACY = 10_000, 800


def top_error(rows: int, tracked: int = TRACKED) -> float:
    """Keys of more than so many among ``rows`` rows are certainly among those of a merged sketch.

    A sketch's counts are off by at most 3.5 rows in as many as its table has places, merged
    or not; a key is reported if its count less that error exceeds that error.
    """
    return 2 * 3.5 / 2 ** math.ceil(math.log2(math.ceil(tracked / 0.75))) * rows


def rank_error(accuracy: int = ACCURACY) -> float:
    """How far, as a share of the rows, the rank of a sketched percentile may be off.

    1.65 times the bound that holds in 99 of 100 cases (2.296 / accuracy^0.9021): beyond it
    lies one in some ten thousand.
    """
    return 1.65 * 2.296 / accuracy**0.9021


def window_summaries(
    df: DataFrame,
    width: str = "1 minute",
    by: Sequence[str] = (),
    top: Sequence[str] = (),
    values: Sequence[str] = (),
    tracked: int = TRACKED,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``window_start``, the columns of ``by``, ``request_count``, ``top_<key>`` and ``values_<column>``.

    Sketches are built per task and merged in the shuffle, so a window or key of a third of all
    rows sends one row a task.
    """
    sketches = [F.expr(f"approx_top_k_accumulate(`{c}`, {tracked})").alias(f"top_{c}") for c in top]
    sketches += [F.expr(f"kll_sketch_agg_double(CAST(`{c}` AS DOUBLE), {accuracy})").alias(f"values_{c}") for c in values]
    return df.groupBy(F.window("timestamp", width)["start"].alias("window_start"), *by).agg(F.count("*").alias("request_count"), *sketches)


def to_summaries(
    df: DataFrame,
    root: str,
    checkpoint: str,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str = "summaries",
    **what,
) -> StreamingQuery:
    """Store the summaries (see ``window_summaries`` for ``what``) of each micro-batch of events below ``root``."""
    spark = df.sparkSession
    fed_by, resumed = paths.read_text(spark, f"{root}/_query"), query_of(spark, checkpoint)
    if fed_by != resumed and (fed_by or paths.numbered(spark, root, "batch")):
        raise ValueError(f"{root} holds summaries of another query: {fed_by}, the checkpoint is of {resumed}")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            window_summaries(batch, **what).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    query = each_batch(df, write, checkpoint, "append", trigger, available_now, query_name)
    paths.write_text(spark, f"{root}/_query", query.id)
    return query


def read_summaries(spark: SparkSession, root: str, since=None, until=None) -> DataFrame:
    """Stored summaries of the windows that start at ``since`` or later and before ``until``."""
    rows = spark.read.option("basePath", root).parquet(f"{root}/batch=*")
    rows = rows if since is None else rows.filter(F.col("window_start") >= F.lit(since))
    return rows if until is None else rows.filter(F.col("window_start") < F.lit(until))


def merged(summaries: DataFrame, width: str | None = None, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """One summary for each window of ``width`` (for all time without) and group."""
    sketches = [F.expr(f"approx_top_k_combine(`{c}`, {tracked})").alias(c) for c in summaries.columns if c.startswith("top_")]
    sketches += [F.expr(f"kll_merge_agg_double(`{c}`)").alias(c) for c in summaries.columns if c.startswith("values_")]
    window = [] if width is None else [F.window("window_start", width)["start"].alias("window_start")]
    # A sketch cannot be merged from nothing, as a task without rows would in an aggregate without key.
    key = [*window, *by] or [F.lit(0).alias("all")]
    return summaries.groupBy(*key).agg(F.sum("request_count").alias("request_count"), *sketches).drop("all")


def stored_top_k(summaries: DataFrame, events: DataFrame, key: str, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """``rank``, the key and ``request_count``: what ``top_k`` gives on ``events``, mostly without counting all keys.

    The merged sketches name the candidates, at most ``tracked``, and only these are counted in
    the stored ``events`` of the same span. If the last of the ``k`` counts exceeds
    ``top_error``, no other key can be among them; else all keys are counted.
    """
    whole = merged(summaries.select("request_count", f"top_{key}"), tracked=tracked)
    found = materialise(whole.select("request_count", F.expr(f"transform(approx_top_k_estimate(`top_{key}`, {tracked}), x -> x.item)").alias("items")))
    rows = found.agg(F.max("request_count")).first()[0]
    if not rows:
        return top_k(events, key, k)
    candidates = found.select(F.explode("items").alias("candidate"))
    best = materialise(top_k(events.join(candidates, events[key].eqNullSafe(F.col("candidate")), "left_semi"), key, k))
    count, least = best.agg(F.count("*"), F.min("request_count")).first()
    return best if count == k and least > top_error(rows, tracked) else top_k(events, key, k)


def stored_percentiles(summaries: DataFrame, col: str, ps: Sequence[float] = (0.5, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    """The columns of ``by``, ``value_count`` and one column ``p<percent>`` each, from the sketches of ``col`` alone.

    Answers are values of the column whose rank is off by at most ``rank_error`` of the rows.
    Groups without a value are left out.
    """
    sketch = f"`values_{col}`"
    whole = merged(summaries.select(*by, "request_count", f"values_{col}"), by=by).withColumn("value_count", F.expr(f"kll_sketch_get_n_double({sketch})"))
    quantiles = [F.expr(f"kll_sketch_get_quantile_double({sketch}, {float(p)}D)").alias(percentile_name(p)) for p in ps]
    return whole.filter("value_count > 0").select(*by, "value_count", *quantiles)
