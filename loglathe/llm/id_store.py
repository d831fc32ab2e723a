"""Token ids in binary files, with keyed access through minimal perfect hashing.

Documents are sorted by id; each task encodes its range of them and writes payload files of
raw little-endian numbers (16 bits where the vocabulary allows it), each with a file of
record boundaries. A key index finds a document by its id: keys are dealt to buckets of some
thousand by hash, and each bucket gets a minimal perfect hash of cascading bit arrays. A key
takes the first level where its bit is its own, and its slot is the number of bits set before.
The slot holds a fingerprint of the key, the file, the first record and how many records have that key.
So a look-up reads one bucket, one slot, two boundaries and the ids, whatever the size of
the store. Bucket sizes are bounded by the hash, and no table of keys is kept anywhere else.

Files are reached through ``pyarrow.fs`` by URI. A task writes under a name of its own and
its rows name the file, so what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import load, materialise, scratch_dir
from .warc import _filesystem

#: Bytes or records after which a payload file is closed.
FILE_BYTES, FILE_RECORDS = 256 << 20, 1 << 22
#: Keys of a bucket on average, and of an index file on average if there are more keys than tasks need.
BUCKET_KEYS, PART_KEYS = 4096, 1 << 20
#: Bits of the first level for each key of a bucket; every level has so many for each key left.
BITS_A_KEY = 2
#: Records that one row of places names at most, and ids that a task reads on average.
SPAN_RECORDS, TASK_IDS = 4096, 16 << 20
_SLOT = np.dtype([("fingerprint", "<u4"), ("file", "<u4"), ("record", "<u8"), ("records", "<u8")])


# --- encoding


class Encoder:
    """Ids of whole texts by ``tokenizers``, from the ids of their parts.

    The tokenizer of ``word_bpe_49k.json`` normalises, splits and merges inside words: nothing it
    does spans ASCII white space, which it drops. So equal words have equal ids wherever they
    stand. Words of printable ASCII and the letters of U+00C0 to U+00FF are moreover unchanged
    by its normaliser but for case, and fall into the parts of its pattern, whose ids its model
    gives. Short words and parts are remembered until there are too many. A vocabulary
    with other rules encodes whole texts.
    """

    RULES = {
        "normalizer": ["NFC", "Replace", "Lowercase"],
        "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    }
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str | None, most: int = 200_000, longest: int = 48):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        rules = json.loads(self.tokenizer.to_str())
        steps = [n.get("type") for n in (rules["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        added = [t["content"] for t in rules["added_tokens"]]
        self.by_word = steps == self.RULES["normalizer"] and splits == [self.RULES["pattern"], None] and all(t.startswith("<|") for t in added)
        if self.by_word:
            self.model, spelled = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {c: spelled.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
            self.data = [i.to_bytes(self.dtype.itemsize, "little") for i in range(max(self.tokenizer.get_vocab(True).values()) + 1)]
        # What was used since a table was last full, and what was used before that.
        self.words, self.old_words, self.parts, self.old_parts = {}, {}, {}, {}
        self.most, self.longest = most, longest

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        found = self.old_parts.get(part)
        if found is None:
            shown = part if part.isascii() else part.translate(self.letters)
            found = b"".join([self.data[t.id] for t in self.model.tokenize(shown)])
        if len(part) <= self.longest:
            self.parts[part] = found
        return found

    def _word(self, word: bytes) -> bytes:
        found = self.old_words.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            if "<|" in text or not self.PLAIN.fullmatch(text):
                found = self._whole([text])[0]
            else:
                get = self.parts.get
                found = b"".join([get(x) or self._part(x) for x in self.PARTS.findall(text.lower())])
        if len(word) <= self.longest:
            self.words[word] = found
        return found

    def of(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes; null is empty."""
        if not self.by_word:
            return self._whole([(t or b"").decode("utf-8", "replace") for t in texts])
        out = []
        for text in texts:
            if len(self.words) > self.most:
                self.words, self.old_words = {}, self.words
            if len(self.parts) > self.most:
                self.parts, self.old_parts = {}, self.parts
            known = self.words
            # An empty entry would be looked up anew; no word is without ids.
            out.append(b"".join([known.get(w) or self._word(w) for w in (text or b"").split()]))
        return out


# --- payload files


@dataclass(frozen=True)
class IdStore:
    """Payload files in key order: ``(name, records, ids, ids of all files before)``, one entry for up to ``FILE_BYTES``."""

    root: str
    width: int
    files: tuple[tuple[str, int, int, int], ...]


def write_ids(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
              vocabulary: str | None = None) -> tuple[IdStore, DataFrame]:
    """Write the ids of all rows, each ended by ``end_id``, in ascending order of ``id_col``; also ``doc_id, file, record`` of each.

    A null id comes first. Rows of one id are ordered by a hash of their text, then as they
    were read, and may lie in several files. A range of rows is encoded and written by one task as it comes.
    """
    keys = ["doc_id", "text_key", "row"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.monotonically_increasing_id().alias("row"),
        F.col(text_col).cast("binary").alias("text"),
    )
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL("part int, number int, name string, record bigint, n bigint, width int")])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, base = _filesystem(root)
        encoder = Encoder(vocabulary)
        width, end = encoder.dtype.itemsize, np.array([end_id], encoder.dtype).tobytes()
        part, number, out, ends = TaskContext.get().partitionId(), -1, None, []

        def close() -> None:
            if out is not None:
                out.close()
                with filesystem.open_output_stream(f"{base}/{name}.idx", compression=None) as f:
                    f.write(np.concatenate([[0], np.cumsum(ends)]).astype("<u8").tobytes())

        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            got = {k: [] for k in ("number", "name", "record", "n")}
            for found in encoder.of(batch.column(1).to_pylist()):
                if out is None or len(ends) >= FILE_RECORDS or out.tell() >= FILE_BYTES:
                    close()
                    filesystem.create_dir(f"{base}/ids", recursive=True)
                    name, number, ends = f"ids/{uuid.uuid4().hex}", number + 1, []
                    out = filesystem.open_output_stream(f"{base}/{name}.bin", compression=None)
                n = len(found) // width + 1
                for k, v in zip(got, (number, name, len(ends), n), strict=True):
                    got[k].append(v)
                out.write(found + end)
                ends.append(n)
            columns = [batch.column(0), pa.array([part] * batch.num_rows, pa.int32()), pa.array(got["number"], pa.int32())]
            columns += [pa.array(got["name"], pa.string()), pa.array(got["record"], pa.int64()), pa.array(got["n"], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([width] * batch.num_rows, pa.int32())], names=schema.names)
        close()

    written = materialise(ordered.mapInArrow(write, schema))
    sums = written.groupBy("part", "number", "name").agg(F.count("*").alias("records"), F.sum("n").alias("ids"), F.max("width").alias("width"))
    files, before, width = [], 0, 2
    for r in sorted(sums.collect()):  # one row for each file
        files.append((r["name"], r["records"], r["ids"], before))
        before, width = before + r["ids"], r["width"]
    store = IdStore(root, width, tuple(files))
    order = {name: i for i, (name, *_) in enumerate(files)}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file = pa.array([order[name] for name in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), file, batch.column(2)], names=["doc_id", "file", "record"])

    places = StructType([rows.schema["doc_id"], *StructType.fromDDL("file bigint, record bigint")])
    return store, written.select("doc_id", "name", "record").mapInArrow(number, places)


# --- the key index


def _key(doc_id: Column) -> Column:
    """A null id is no text; an empty one is ``=``."""
    return F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))


def _hashes(doc_id: Column) -> tuple[Column, Column]:
    return F.xxhash64(_key(doc_id)), F.xxhash64(F.lit("second"), _key(doc_id))


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h1 + np.uint64(level) * h2) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x = (x + h2) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct pairs of 64-bit hashes: cascading bit arrays with ranks."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.first = np.concatenate([[0], np.cumsum([-(-s // 64) for s in sizes])]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, words, level = [], [], 0
        while len(h1):
            if level > 100:
                raise ValueError("two keys have one hash of 128 bits")
            size = max(64, BITS_A_KEY * len(h1))
            place = _place(h1, h2, level, size)
            alone = np.bincount(place, minlength=size) == 1
            bits = np.zeros(-(-size // 64) * 64, np.uint8)
            bits[:size] = alone
            sizes.append(size), words.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = ~alone[place]
            h1, h2, level = h1[left], h2[left], level + 1
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key; -1, or any slot, for a key that is not in the set."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            place = _place(h1[left], h2[left], level, size)
            word, bit = self.first[level] + (place >> 6), (place & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[left[hit]] = self.rank[word[hit]] + below
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        return struct.pack(f"<I{len(self.sizes)}I", len(self.sizes), *self.sizes) + self.words.astype("<u8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        (levels,) = struct.unpack_from("<I", data)
        return cls(list(struct.unpack_from(f"<{levels}I", data, 4)), np.frombuffer(data, "<u8", offset=4 + 4 * levels))


@dataclass(frozen=True)
class KeyIndex:
    """Number of buckets, and the index files; file ``i`` holds the buckets ``b`` with ``b % len(files) == i``."""

    root: str
    buckets: int
    files: tuple[str, ...]


def build_index(places: DataFrame, store: IdStore, buckets: int | None = None) -> KeyIndex:
    """Minimal perfect hashes over the distinct ids of ``doc_id, file, record``, in index files below the store.

    Records of one key follow one another, so its first place and their number say all. A
    file starts with a table of three offsets for each of its buckets: hash, slots, end.
    """
    keys = places.groupBy("doc_id").agg(F.min(F.struct("file", "record")).alias("first"), F.count("*").alias("records"))
    h1, h2 = _hashes(F.col("doc_id"))
    keys = materialise(keys.select(h1.alias("h1"), h2.alias("h2"), "first.file", "first.record", "records"))
    n = keys.count()
    buckets = buckets or -(-n // BUCKET_KEYS)
    parts = min(buckets, max(places.sparkSession.sparkContext.defaultParallelism, -(-n // PART_KEYS)))
    if not parts:
        return KeyIndex(store.root, 0, ())
    rows = keys.withColumn("bucket", F.pmod("h1", F.lit(buckets))).withColumn("part", F.col("bucket") % parts)
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "bucket").select("part", "bucket", "h1", "h2", "file", "record", "records")
    root = store.root

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(root)
        part, bucket, held, out, name = None, None, [], None, None

        def put() -> None:
            if not held:
                return
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            a, b = columns[0].view(np.uint64), columns[1].view(np.uint64)
            function = PerfectHash.build(a, b)
            slots = np.zeros(len(a), _SLOT)
            at = function.slots(a, b)
            slots["fingerprint"][at] = (b & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            for field, column in zip(("file", "record", "records"), columns[2:], strict=True):
                slots[field][at] = column
            start = out.tell()
            out.write(function.dump())
            middle = out.tell()
            out.write(slots.tobytes())
            table[bucket // parts] = (start, middle, out.tell())
            held.clear()

        def close() -> pa.RecordBatch:
            put()
            out.close()
            with filesystem.open_output_stream(f"{base}/{name}.dir", compression=None) as f:
                f.write(table.astype("<u8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([name])], names=["part", "name"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(7)]
            marks = np.flatnonzero(np.diff(columns[1])) + 1
            for i, j in zip([0, *marks.tolist()], [*marks.tolist(), batch.num_rows], strict=True):
                if i == j:
                    continue
                if columns[1][i] != bucket:
                    if out is not None and columns[0][i] != part:
                        yield close()
                        out = None
                    elif out is not None:
                        put()
                    if out is None:
                        part, name = int(columns[0][i]), f"keys/{uuid.uuid4().hex}"
                        filesystem.create_dir(f"{base}/keys", recursive=True)
                        out = filesystem.open_output_stream(f"{base}/{name}.mph", compression=None)
                        table = np.zeros((-(-(buckets - part) // parts), 3), np.int64)
                    bucket = int(columns[1][i])
                held.append([c[i:j] for c in columns[2:]])
        if out is not None:
            yield close()

    made = materialise(rows.mapInArrow(write, "part bigint, name string"))
    names = {r["part"]: r["name"] for r in made.collect()}  # one row for each index file
    return KeyIndex(root, buckets, tuple(names.get(i, "") for i in range(parts)))


class _Keys:
    """Look-ups in an index; keeps the last bucket."""

    def __init__(self, index: KeyIndex):
        self.index, (self.filesystem, self.base) = index, _filesystem(index.root)
        self.bucket, self.function, self.slots = None, None, np.zeros(0, _SLOT)

    def _open(self, bucket: int) -> None:
        self.bucket, self.function = bucket, None
        parts = len(self.index.files)
        name = self.index.files[bucket % parts]
        if not name:
            return
        with self.filesystem.open_input_file(f"{self.base}/{name}.dir") as f:
            start, middle, end = np.frombuffer(f.read_at(24, 24 * (bucket // parts)), "<u8").tolist()
        if end > start:
            with self.filesystem.open_input_file(f"{self.base}/{name}.mph") as f:
                data = f.read_at(end - start, start)
            self.function = PerfectHash.load(data[: middle - start])
            self.slots = np.frombuffer(data, _SLOT, offset=middle - start)

    def find(self, bucket: int, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of a bucket's keys are known, and the slots of those."""
        if bucket != self.bucket:
            self._open(bucket)
        if self.function is None:
            return np.zeros(len(h1), bool), self.slots[:0]
        at = self.function.slots(h1, h2)
        got = self.slots[np.maximum(at, 0)]
        known = (at >= 0) & (got["fingerprint"] == (h2 & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        return known, got[known]


def look_up(wanted: DataFrame, index: KeyIndex, store: IdStore, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, file, record, records`` of each distinct id of ``wanted`` that the index knows.

    An id with many records gives a row for every file and ``SPAN_RECORDS``. An id the store does
    not hold is found in one of 2^32 cases. Requests meet by bucket, so each is read once.
    """
    distinct = wanted.select(F.col(id_col).alias("doc_id")).distinct()
    h1, h2 = _hashes(F.col("doc_id"))
    rows = distinct.select("doc_id", h1.alias("h1"), h2.alias("h2")).withColumn("bucket", F.pmod("h1", F.lit(max(index.buckets, 1))))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    sizes = [records for _, records, _, _ in store.files]

    def spans(slot: np.void) -> Iterator[tuple[int, int, int]]:
        file, record, left = int(slot["file"]), int(slot["record"]), int(slot["records"])
        while left:
            n = min(left, sizes[file] - record, SPAN_RECORDS)
            yield file, record, n
            left, record = left - n, record + n
            if record == sizes[file]:
                file, record = file + 1, 0

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys(index)
        for batch in batches:
            if not index.buckets:
                continue
            a, b, bucket = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            marks = np.flatnonzero(np.diff(bucket)) + 1
            got: list[tuple] = []
            for i, j in zip([0, *marks.tolist()], [*marks.tolist(), batch.num_rows], strict=True):
                if i < j:
                    known, slots = keys.find(int(bucket[i]), a[i:j].view(np.uint64), b[i:j].view(np.uint64))
                    for at, slot in zip((np.flatnonzero(known) + i).tolist(), slots, strict=True):
                        got += [(at, *span) for span in spans(slot)]
            columns = list(zip(*got, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", "file", "record", "records"]
            )

    schema = StructType([StructField("doc_id", wanted.schema[id_col].dataType), *StructType.fromDDL("file bigint, record bigint, records bigint")])
    return rows.mapInArrow(find, schema)


# --- reading


class _Payload:
    """Record boundaries and ids of a store; keeps the last file open."""

    def __init__(self, store: IdStore):
        self.store, (self.filesystem, self.base), self.at = store, _filesystem(store.root), None

    def ends(self, file: int, record: int, records: int) -> np.ndarray:
        if self.at != file:
            name = self.store.files[file][0]
            self.bin, self.idx = (self.filesystem.open_input_file(f"{self.base}/{name}.{x}") for x in ("bin", "idx"))
            self.at = file
        return np.frombuffer(self.idx.read_at(8 * (records + 1), 8 * record), "<u8").astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids of the file last asked for, as unsigned 32-bit numbers."""
        width = self.store.width
        return np.frombuffer(self.bin.read_at((end - start) * width, start * width), f"<u{width}").astype("<u4")


def read_ids(places: DataFrame, store: IdStore, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each record at stored ``places``, read from the files.

    ``start`` counts the ids of all records before. Places are sorted, and neighbouring
    ones are read together.
    """
    schema = StructType([places.schema["doc_id"], *StructType.fromDDL("start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else ""))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload = _Payload(store)
        for batch in batches:
            file, record, records = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            i = 0
            while i < batch.num_rows:
                j, total = i + 1, int(records[i])
                while j < batch.num_rows and file[j] == file[i] and record[j] == record[i] + total and total < SPAN_RECORDS:
                    j, total = j + 1, total + int(records[j])
                ends = payload.ends(int(file[i]), int(record[i]), total)
                crc, lists, k = [], [], 0
                while k < total:  # some million ids at a time, or one longer record
                    last = max(k + 1, int(np.searchsorted(ends, ends[k] + (1 << 21), side="right")) - 1)
                    data = payload.ids(int(ends[k]), int(ends[last]))
                    raw, at = memoryview(data).cast("B"), (4 * (ends[k : last + 1] - ends[k])).tolist()
                    crc += [zlib.crc32(raw[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
                    if with_ids:
                        lists += [data[x // 4 : y // 4].astype(np.int64) for x, y in zip(at[:-1], at[1:], strict=True)]
                    k = last
                whose = pa.array(np.repeat(np.arange(i, j), records[i:j]), pa.int64())
                columns = [batch.column(0).take(whose), pa.array(ends[:-1] + store.files[int(file[i])][3]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                i = j

    total = sum(ids for _, _, ids, _ in store.files)
    parts = max(places.sparkSession.sparkContext.defaultParallelism, total // TASK_IDS)
    ordered = places.repartitionByRange(int(parts), "file", "record").sortWithinPartitions("file", "record")
    return ordered.select("doc_id", "file", "record", "records").mapInArrow(read, schema)


def ids_of(key, index: KeyIndex, store: IdStore) -> list[list[int]]:
    """The ids of each record of one key, read on the driver; none for an unknown key."""
    import xxhash

    data = b"" if key is None else f"={key}".encode()
    h1 = xxhash.xxh64_intdigest(data, 42)
    h2 = xxhash.xxh64_intdigest(data, xxhash.xxh64_intdigest(b"second", 42))
    if not index.buckets:
        return []
    signed = h1 - (1 << 64) if h1 >> 63 else h1
    known, slots = _Keys(index).find(signed % index.buckets, np.array([h1], np.uint64), np.array([h2], np.uint64))
    if not known[0]:
        return []
    payload, out = _Payload(store), []
    file, record = int(slots[0]["file"]), int(slots[0]["record"])
    for _ in range(int(slots[0]["records"])):
        ends = payload.ends(file, record, 1)
        out.append(payload.ids(int(ends[0]), int(ends[1])).tolist())
        record += 1
        if record == store.files[file][1]:
            file, record = file + 1, 0
    return out


def save(store: IdStore, index: KeyIndex) -> None:
    """Write what ``open_store`` needs beside the files."""
    filesystem, base = _filesystem(store.root)
    filesystem.create_dir(base, recursive=True)
    with filesystem.open_output_stream(f"{base}/store.json", compression=None) as f:
        f.write(json.dumps({"width": store.width, "files": store.files, "buckets": index.buckets, "keys": index.files}).encode())


def open_store(root: str) -> tuple[IdStore, KeyIndex]:
    filesystem, base = _filesystem(root)
    with filesystem.open_input_file(f"{base}/store.json") as f:
        kept = json.loads(f.readall())
    return IdStore(root, kept["width"], tuple(map(tuple, kept["files"]))), KeyIndex(root, kept["buckets"], tuple(kept["keys"]))


def build_store(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                vocabulary: str | None = None) -> tuple[IdStore, KeyIndex]:
    """Encode all rows and write payload files and key index below ``root``.

    A null or empty text is ``end_id`` alone, a null id is a key of its own. Rows that repeat
    an id have one key and a record each; ties of the id are ordered by a hash of the text.
    Texts are encoded whole, each in one task. An empty table gives an empty store. Other
    columns are not read.
    """
    store, places = write_ids(docs, root, id_col, text_col, end_id, vocabulary)
    index = build_index(places, store)
    save(store, index)
    return store, index


def op12_perfect_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written, and each read back by its key."""
    docs, root = load(spark, sf_dir, "documents"), scratch_dir(spark)
    store, index = build_store(docs, root)
    return read_ids(materialise(look_up(docs, index, store)), store)
