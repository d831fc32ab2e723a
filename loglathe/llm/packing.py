"""Packing of token sequences, shortest pack first over the length histogram.

Documents become pieces of at most ``max_len`` tokens. Only the histogram of piece
lengths reaches the driver (``max_len`` numbers, whatever the corpus). There, lengths
are placed from the longest to the shortest, each into the open packs with the most
room, all packs of one pattern at a time. The resulting pattern counts are turned into
intervals of ranks, and each piece finds its sequence by its rank among the pieces of
its length.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, with_rank

MAX_LEN = 2048
#: Rows a task ranks at most on average; sets into how many buckets a length is dealt.
RANK_ROWS = 500_000


def _encoding(path: str | None, added_tokens: bool):
    """The byte-level BPE vocabulary ``byte_bpe_50k``, as ranks.

    ``byte_bpe_50k.json`` and ``byte_bpe_50k.tiktoken`` hold one vocabulary; the tests
    compare the ids. The second is read four times faster, and has no added tokens: these
    come from the file of the same name that ends in ``.json``.
    """
    import json
    import sys
    from types import ModuleType

    import public_tokenizers
    import tiktoken

    # A task function is unpickled for each task; the worker process keeps what lies in a module.
    kept = vars(sys.modules.setdefault("loglathe_encodings", ModuleType("loglathe_encodings")))
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if (path, added_tokens) not in kept:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        added = []
        if added_tokens:
            with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
                added = json.load(file)["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens are matched as they are spelled, without their blanks or word edges")
        special = {t["content"]: t["id"] for t in added}
        kept[path, added_tokens] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return kept[path, added_tokens]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
           end_id: int = 1, vocabulary: str | None = None, with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Token pieces ``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``).

    A document is its token ids and then ``end_id``; a null or empty text is ``end_id``
    alone. It is cut every ``max_len`` ids. With ``added_tokens`` the added tokens of the
    vocabulary (``<|endoftext|>``) have their own id inside texts too, as ``tokenizers``
    gives with ``add_special_tokens=False``; without, their spelling is ordinary text.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<bigint>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary, added_tokens).encode_to_numpy
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.append(encode(text, allowed_special="all", disallowed_special=()) if text else np.array([], "<u4"), end_id).astype("<u4")
                for at in range(0, len(tokens), max_len):
                    piece = tokens[at : at + max_len]
                    rows.append(i), start.append(at), length.append(len(piece)), total.append(len(tokens))
                    crc.append(zlib.crc32(piece.tobytes()))
                    if with_ids:
                        ids.append(piece.astype(np.int64))
            columns = [batch.column(0).take(pa.array(rows, pa.int32()))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def shortest_pack_first(histogram: np.ndarray, room: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Packing patterns ``(count, ((length, times), ...))`` for ``histogram[length]`` items.

    Each step fills, or splits in two, one group of equal packs, so there are some
    thousands of patterns however many items there are.
    """
    open_packs: dict[int, list[tuple[int, tuple]]] = {}
    most: list[int] = []  # rooms of open packs, negated
    done = []

    def put(left: int, count: int, pattern: tuple) -> None:
        if left == 0:
            done.append((count, pattern))
            return
        if left not in open_packs:
            open_packs[left] = []
            heapq.heappush(most, -left)
        open_packs[left].append((count, pattern))

    for length in range(room, 0, -1):
        items = int(histogram[length])
        while items:
            if not most or -most[0] < length:
                times = room // length
                if items >= times:  # full packs of this length alone
                    put(room - times * length, items // times, ((length, times),))
                    items %= times
                else:
                    put(room - items * length, 1, ((length, items),))
                    items = 0
                continue
            left = -most[0]
            count, pattern = open_packs[left].pop()
            if not open_packs[left]:
                heapq.heappop(most)
                del open_packs[left]
            used = min(items, count)
            if used < count:
                put(left, count - used, pattern)
            same = pattern[-1][0] == length
            grown = (*pattern[:-1], (length, pattern[-1][1] + 1)) if same else (*pattern, (length, 1))
            put(left - length, used, grown)
            items -= used
    return done + [group for groups in open_packs.values() for group in groups]


def _intervals(patterns: list, room: int) -> dict[str, np.ndarray]:
    """For each length, ranks from ``first`` on lie in sequences from ``sequence`` on, ``times`` in each."""
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, count * times, sequence, times, offset))
            offset += length * times
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    length, items = table[:, 0], table[:, 1]
    before = np.cumsum(items) - items
    starts = np.searchsorted(length, np.arange(room + 2))
    first = before - before[np.minimum(starts[length], max(len(table) - 1, 0))] if len(table) else before
    return {"length": length, "first": first, "sequence": table[:, 2], "times": table[:, 3], "offset": table[:, 4], "starts": starts}


def pack(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces with ``doc_id, start, length``.

    ``parts`` is read several times: give a written table. Ties and repeated rows are
    ranked one after the other, an empty table gives no rows.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    histogram = np.zeros(max_len + 1, dtype=np.int64)
    for row in parts.groupBy("length").count().collect():  # at most max_len rows
        histogram[row["length"]] = row["count"]
    where = _intervals(shortest_pack_first(histogram, max_len), max_len)
    buckets = max(64, int(histogram.sum()) // RANK_ROWS)
    ranked = with_rank(parts, ["length"], [F.col("doc_id"), F.col("start")], F.xxhash64("doc_id", "start"), "rank_of_length", buckets)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Intervals are sorted by length and first rank: one search over a combined key.
        span = int(histogram.max(initial=0)) + 1
        keys = where["length"] * span + where["first"]
        for batch in batches:
            length = batch.column(batch.schema.names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            i = np.searchsorted(keys, length * span + rank, side="right") - 1
            inside = rank - where["first"][i]
            sequence = where["sequence"][i] + inside // where["times"][i]
            offset = where["offset"][i] + inside % where["times"][i] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return ranked.mapInArrow(place, StructType([*parts.schema.fields, *added]))


def op3_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens."""
    return pack(materialise(pieces(load(spark, sf_dir, "documents"), added_tokens=True)))
