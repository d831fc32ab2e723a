"""Streaming sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import document_id, stamp
from ..schema import table_for
from ..session import conf_values
from ..store import paths, tables

TRIGGER = "30 seconds"


def search_index_options(hosts: str | list[str], index: str, port: int = 9200) -> dict[str, str]:
    """Options of the search-index connector; the document id makes writes repeatable."""
    names = [hosts] if isinstance(hosts, str) else list(hosts)
    # The connector's option names.
    return {
        "es.nodes": ",".join(name.split("://", 1)[-1] for name in names),
        "es.port": str(port),
        "es.resource": index,
        "es.nodes.wan.only": "true",
        "es.index.auto.create": "true",
        "es.mapping.id": "doc_id",
    }


def with_document_id(df: DataFrame, analysis: str) -> DataFrame:
    return df.withColumn("doc_id", document_id(df, analysis))


def each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], object],
    checkpoint: str,
    output_mode: str,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``; a failing write stops the query."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Errors must reach Spark: it stops the query and replays the batch.
        write(batch, batch_id)

    writer = df.writeStream.foreachBatch(sink).outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.queryName(query_name) if query_name else writer
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    # The number of state partitions is fixed by the first start.
    with conf_values(df.sparkSession, spark__sql__shuffle__partitions=state_partitions):
        return writer.start()


def _start(
    df: DataFrame,
    write: Callable[[DataFrame, int], object],
    analysis: str,
    checkpoint: str,
    trigger: str,
    available_now: bool,
    query_name: str | None,
    state_partitions: int | None,
) -> StreamingQuery:
    mode = table_for(analysis).output_mode
    return each_batch(df, write, checkpoint, mode, trigger, available_now, query_name or analysis, state_partitions)


def query_of(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query a checkpoint belongs to."""
    text = paths.read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    return json.loads(text)["id"] if text else None


def _claim(spark: SparkSession, analysis: str, root: str, checkpoint: str) -> None:
    """Refuse a table and a checkpoint that do not belong together.

    A fresh checkpoint numbers its batches from 0 and would mix with older ones.
    """
    fed_by, resumed = tables.owner(spark, root, analysis), query_of(spark, checkpoint)
    if fed_by and fed_by != resumed:
        raise ValueError(f"table {analysis} belongs to query {fed_by}, the checkpoint to {resumed}")
    if not fed_by and not resumed and tables.last_batch(spark, root, analysis) != tables.NO_BATCH:
        raise ValueError(f"table {analysis} already holds batches of another writer")


def to_table(
    df: DataFrame,
    analysis: str,
    root: str,
    checkpoint: str,
    trigger: str = TRIGGER,
    available_now: bool = False,
    fmt: str | None = None,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write a streaming analysis to its table, one folder per micro-batch.

    A replayed batch replaces its own folder, so a restart loses and doubles
    nothing. Empty batches leave no trace. Rows that do not fit the table are kept
    beside it, see ``read_refused``.
    """
    spark = df.sparkSession
    _claim(spark, analysis, root, checkpoint)
    query = _start(
        df,
        lambda batch, batch_id: tables.write_batch(batch, analysis, root, batch_id, fmt=fmt),
        analysis,
        checkpoint,
        trigger,
        available_now,
        query_name,
        state_partitions,
    )
    tables.set_owner(spark, root, analysis, query.id)
    return query


def to_connector(
    df: DataFrame,
    analysis: str,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write a streaming analysis through a batch data source such as a search index.

    Rows carry ``doc_id``, equal for every version of a key, so that the target
    keeps the last version and a replay changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        documents = stamp(with_document_id(batch, analysis))
        documents.write.format(fmt).options(**options).mode("append").save()

    return _start(df, write, analysis, checkpoint, trigger, available_now, query_name, state_partitions)


def to_console(df: DataFrame, name: str, trigger: str = TRIGGER, available_now: bool = False) -> StreamingQuery:
    """Print appended rows, up to 20 per batch, in full width."""
    writer = df.writeStream.outputMode("append").format("console").queryName(name)
    writer = writer.option("truncate", False).option("numRows", 20)
    return (
        writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    ).start()


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append a stream that only adds rows, such as parsed events, to plain files.

    Each row is stored exactly once over restarts. Streams that read the folder
    share the parsing: see ``read_events``.
    """
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start(path)
