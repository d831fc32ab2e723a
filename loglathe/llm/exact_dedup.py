"""Exact copies by sorting the content.

Normalised texts are range-partitioned at sampled splitters and sorted, so equal texts
become neighbours; neighbours are compared in full. The splitters are taken on the first
``PREFIX`` bytes instead of whole texts, so the driver's sample stays small; the digest orders
only texts that agree in these, so that those are still spread, and a group of copies with a third of
all rows is cut by id over many tasks. Runs that reach over a partition edge are joined
afterwards from at most two rows a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import load, materialise

#: Bytes of the normalised text that place it; the digest breaks ties.
PREFIX = 96
WHITE_SPACE = r"[\x20\x09-\x0D]+"


_KEPT = [0, 1, 2]  # id, length and digest: not the text


class _Runs:
    """Runs of equal neighbours in one sorted partition, of which only the last stays open.

    What stays open has one text, and of its rows the id, length and digest.
    """

    def __init__(self, schema: pa.Schema, pid: int):
        self.schema, self.pid, self.number, self.open = schema, pid, 0, None

    def _emit(self, rows: pa.RecordBatch, keep: pa.Array, size: np.ndarray, number: np.ndarray, edge: pa.Array) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows.column(0), keep, pa.array(size, pa.int64()), rows.column(2), rows.column(1),
             pa.array(np.full(n, self.pid, np.int32)), pa.array(number, pa.int64()), edge],
            schema=self.schema,
        )

    def close(self, last: bool) -> Iterator[pa.RecordBatch]:
        """The open run; the text goes along if the run lies at an edge of the partition."""
        if self.open is None:
            return
        text, chunks = self.open
        size, keep = sum(c.num_rows for c in chunks), chunks[0].column(0).slice(0, 1)
        for i, chunk in enumerate(chunks):
            n = chunk.num_rows
            at_edge = i == 0 and (last or self.number == 0)
            edge = pa.concat_arrays([pa.array([text if at_edge else None], pa.binary()), pa.nulls(n - 1, pa.binary())])
            yield self._emit(chunk, keep.take(pa.array(np.zeros(n, np.int64))), np.full(n, size), np.full(n, self.number), edge)
        self.number, self.open = self.number + 1, None

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, n = batch.column(3), batch.num_rows
        differs = pc.invert(pc.equal(text.slice(1), text.slice(0, n - 1))).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(differs) + 1]).astype(np.int64)
        if self.open is not None and self.open[0] == text[0].as_py():
            end = int(starts[1]) if len(starts) > 1 else n
            self.open[1].append(batch.select(_KEPT).slice(0, end))
            starts = starts[1:]
        if not len(starts):
            return
        yield from self.close(last=False)
        if self.number == 0:  # the partition's first run goes through close(), for its text
            end = int(starts[1]) if len(starts) > 1 else n
            self.open = (text[int(starts[0])].as_py(), [batch.select(_KEPT).slice(int(starts[0]), end - int(starts[0]))])
            starts = starts[1:]
            if not len(starts):
                return
            yield from self.close(last=False)
        if len(starts) > 1:
            first, last = int(starts[0]), int(starts[-1])
            sizes = np.diff(starts)
            rows = batch.slice(first, last - first)
            at = np.repeat(starts[:-1] - first, sizes)
            number = self.number + np.repeat(np.arange(len(sizes)), sizes)
            yield self._emit(rows, rows.column(0).take(pa.array(at)), np.repeat(sizes, sizes), number, pa.nulls(len(at), pa.binary()))
            self.number += len(sizes)
        last = int(starts[-1])
        self.open = (text[last].as_py(), [batch.select(_KEPT).slice(last)])


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row.

    Texts are equal if they are identical without ASCII white space; null counts as
    empty, and empty texts are copies of each other. In a group the row with the longest
    original text stays, then the one with the smallest id (null ids last). Rows that
    repeat the staying id in its group are all kept. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.length(text).alias("n"), F.regexp_replace(text, WHITE_SPACE, "").alias("norm")
    ).select("id", "n", F.unhex(F.sha2("norm", 256)).alias("sha"), F.col("norm").cast("binary").alias("norm"))
    rows = rows.withColumn("prefix", F.substring("norm", 1, PREFIX))
    ordered = rows.repartitionByRange("prefix", "sha", "id").sortWithinPartitions(
        "prefix", "sha", "norm", F.desc("n"), F.asc_nulls_last("id")
    ).select("id", "n", "sha", "norm")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, keep {id_type}, size bigint, sha binary, n int, pid int, run bigint, edge binary"

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                if state is None:
                    kind = batch.schema.field(0).type
                    state = _Runs(pa.schema([
                        ("id", kind), ("keep", kind), ("size", pa.int64()), ("sha", pa.binary()), ("n", pa.int32()),
                        ("pid", pa.int32()), ("run", pa.int64()), ("edge", pa.binary()),
                    ]), TaskContext.get().partitionId())
                yield from state.add(batch)
        if state is not None:
            yield from state.close(last=True)

    found = materialise(ordered.mapInArrow(runs, schema))
    joined = found.join(F.broadcast(_stitched(found)), ["pid", "run"], "left")
    keep = F.when(F.col("whole_size").isNotNull(), F.col("whole_keep")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("whole_size", "size").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _stitched(found: DataFrame) -> DataFrame:
    """Size and staying row of the runs that go on beyond a partition's edge.

    At most two runs a partition lie at an edge. Their numbers are ordered in one small
    window; the texts of successive edge runs are compared in full by a join.
    """
    edges = found.filter(F.col("edge").isNotNull()).select("pid", "run", "keep", "size", "n", "edge")
    order = W.orderBy("pid", "run")
    numbered = edges.select("pid", "run").withColumn("seq", F.row_number().over(order))
    edges = edges.join(F.broadcast(numbered), ["pid", "run"])
    before = edges.select((F.col("seq") + 1).alias("seq"), F.col("edge").alias("edge_before"))
    same = F.coalesce(F.col("edge") == F.col("edge_before"), F.lit(False))
    linked = edges.join(before, "seq", "left").select("pid", "run", "keep", "size", "n", "seq", same.alias("same"))
    chain = F.sum((~F.col("same")).cast("int")).over(W.orderBy("seq"))
    best = F.struct((-F.col("n")).alias("n"), F.col("keep").isNull().alias("no_id"), F.col("keep").alias("keep"))
    of_chain = W.partitionBy("chain")
    return linked.withColumn("chain", chain).select(
        "pid", "run",
        F.sum("size").over(of_chain).alias("whole_size"),
        F.min(best).over(of_chain)["keep"].alias("whole_keep"),
    )


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return copies(load(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""
