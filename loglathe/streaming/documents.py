"""Documents sent to a target that takes them in bulks and may refuse single ones.

What a batch sends is a Spark job whose output are the refused documents with the target's reasons. Spark commits
that output once all tasks are done: a failed task is tried again and resends its bulks, a failed
batch leaves nothing and is replayed, and a replay replaces the refused ones of its batch. Documents have an
id of their own, so sending them again changes nothing at the target.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import stamp
from ..schema import table_for
from ..store import WriteResult, paths
from .sinks import TRIGGER, each_batch, with_document_id

#: Takes (id, JSON document) pairs, returns (place in the bulk, reason) of those the target refused.
Send = Callable[[list[tuple[str, str]]], list[tuple[int, str]]]

REFUSED = "doc_id string, document string, reason string"
BULK = 500


def _folder(root: str, analysis: str) -> str:
    return f"{root.rstrip('/')}/{table_for(analysis).name}"


def _sender(send: Send, bulk: int):
    """The task function, made here so that it travels by value."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, documents = batch.column("doc_id").to_pylist(), batch.column("document").to_pylist()
            for low in range(0, len(ids), bulk):
                part = list(zip(ids[low : low + bulk], documents[low : low + bulk], strict=True))
                refused = [(*part[place], str(reason)) for place, reason in send(part)]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "document", "reason"), r, strict=True)) for r in refused], schema=schema)

    import pyarrow as pa

    schema = pa.schema([(name, pa.string()) for name in ("doc_id", "document", "reason")])
    return run


def send_documents(df: DataFrame, analysis: str, send: Send, root: str, batch_id: int, bulk: int = BULK) -> WriteResult:
    """Send the rows of an analysis as JSON documents; keeps those the target refuses below ``root``.

    An error that ``send`` raises fails the task, and after Spark's retries the batch. A batch that is sent
    again replaces its refused documents; one that nothing was refused of leaves no folder.
    """
    spark = df.sparkSession
    folder = f"{_folder(root, analysis)}/batch_id={batch_id}"
    sent, kept = Observation(), Observation()
    rows = stamp(with_document_id(df, analysis))
    body = F.to_json(F.struct(*[c for c in rows.columns if c != "doc_id"]), {"ignoreNullFields": "false"})
    documents = rows.select("doc_id", body.alias("document")).observe(sent, F.count(F.lit(1)).alias("n"))
    refused = documents.mapInArrow(_sender(send, bulk), REFUSED).observe(kept, F.count(F.lit(1)).alias("n"))
    refused.write.mode("overwrite").parquet(folder)
    result = WriteResult(sent.get["n"] - kept.get["n"], kept.get["n"])
    if not result.failed:
        paths.delete(spark, folder)
    return result


def read_refused_documents(spark: SparkSession, analysis: str, root: str) -> DataFrame:
    """Refused documents with ``reason`` and ``batch_id``, of batches that are finished."""
    folder, schema = _folder(root, analysis), f"{REFUSED}, batch_id bigint"
    numbers = paths.numbered(spark, folder, "batch_id")
    if not numbers:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", folder)
    return reader.parquet(*[f"{folder}/batch_id={n}" for n in numbers])


def to_documents(
    df: DataFrame,
    analysis: str,
    send: Send,
    root: str,
    checkpoint: str,
    bulk: int = BULK,
    trigger: str = TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Send a streaming analysis to a target, in the output mode of its table."""
    return each_batch(
        df, lambda batch, number: send_documents(batch, analysis, send, root, number, bulk), checkpoint, table_for(analysis).output_mode,
        trigger, available_now, query_name or analysis, state_partitions,
    )
