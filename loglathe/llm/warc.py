"""WARC archives with a two-level capture index.

Pages become WARC records, one gzip member each, in archive files written by the tasks.
The index sorts captures by reversed-host URL key into files of compressed blocks; a
sparse directory beside each file holds the first key of every block. A look-up finds
the file among the first keys of all index files, the block in that file's directory by
binary search, reads just that block, and then just the record.

Files are reached through ``pyarrow.fs`` by URI (file, hdfs, s3, gs, abfs). A task writes
under a name of its own and its rows name the file, so what a lost or repeated attempt
leaves behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise, scratch_dir

#: Bytes after which an archive file is closed, and captures in a block of the index.
FILE_BYTES, BLOCK_LINES = 256 << 20, 1000
#: Compressed bytes of records that one task reads: places alone are small and would meet in few tasks.
TASK_BYTES = 32 << 20
#: Date of all records: pages carry none.
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str):
    """The file system of a URI or local path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.example.com/a?b`` is ``com,example,www)/a?b``. Null is ``-``.

    Scheme, user and fragment do not count, the host has no case; a text without host keeps its place.
    """
    if url is None:
        return "-"
    rest = url.split("#", 1)[0]
    rest = rest.split("://", 1)[1] if "://" in rest else rest
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:] or "/"
    name, colon, port = host.partition(":")
    return quote(",".join(reversed(name.split("."))) + colon + port + ")" + path, safe="".join(map(chr, range(33, 127))))


def _record_id(page: str | None) -> str:
    return f"<urn:x-page:{quote(page or '', safe='')}>"


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit has the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127)))) if url is not None else 'urn:x-page:'}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one gzip member."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")

    def fields(lines: bytes) -> dict[str, str]:
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8").split("\r\n")[1:])}

    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``root``; one row ``key, page, file, offset, length`` for each record, stored.

    Of equal payloads of ``least_bytes`` or more the record with the smallest id is the
    response and the others revisit it (null ids are never the smallest if there is
    another). A null payload is empty. Rows that repeat the smallest id and the payload
    are responses too.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.cast("binary").alias("payload"), F.sha2(payload.cast("binary"), 256).alias("sha")
    )
    # Counted before the shuffle; joined to one row per repeated payload, so a hot payload can be split.
    large = F.octet_length("payload") >= least_bytes
    repeated = rows.filter(large).groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("first_page")).filter("n > 1")
    repeated = repeated.select(F.col("sha").alias("repeated_sha"), F.col("first_page").cast("string").alias("first_page"))
    joined = rows.join(repeated, rows["sha"] == F.col("repeated_sha"), "left").select(
        F.col("page_id").cast("string").alias("page"), "url", "payload", "first_page",
        (F.col("repeated_sha").isNotNull() & ~F.col("page_id").cast("string").eqNullSafe(F.col("first_page"))).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(root)
        out = None
        try:
            for batch in batches:
                got = {k: [] for k in ("key", "page", "file", "offset", "length")}
                for page, url, data, first, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or out.tell() >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"warc/{uuid.uuid4().hex}.warc.gz"
                        filesystem.create_dir(f"{base}/warc", recursive=True)
                        out = filesystem.open_output_stream(f"{base}/{name}", compression=None)
                    member = record(page, url, data, first, revisit)
                    for k, v in zip(got, (url_key(url), page, name, out.tell(), len(member)), strict=True):
                        got[k].append(v)
                    out.write(member)
                yield pa.RecordBatch.from_arrays([*(pa.array(got[k], pa.string()) for k in ("key", "page", "file")), *(pa.array(got[k], pa.int64()) for k in ("offset", "length"))], names=list(got))
        finally:
            if out is not None:
                out.close()

    return materialise(joined.mapInArrow(write, "key string, page string, file string, offset bigint, length bigint"))


def _entry_key() -> Column:
    """URL key and page of a capture; no page at all is not the same as an empty name."""
    return F.concat(F.col("key"), F.lit("\t"), F.coalesce(F.concat(F.lit("="), F.col("page")), F.lit("-")))


@dataclass(frozen=True)
class CaptureIndex:
    """Where the files are, and ``(first key, index file, directory file)`` of each index file, sorted.

    One entry for each partition of the index build, not for each block.
    """

    root: str
    files: tuple[tuple[bytes, str, str], ...]


def build_index(captures: DataFrame, root: str) -> CaptureIndex:
    """Sort captures by key (then page) into index files of gzip blocks with a block directory each."""
    keyed = captures.select(_entry_key().alias("k"), "file", "offset", "length")
    ordered = keyed.repartitionByRange("k", "file", "offset").sortWithinPartitions("k", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(root)
        name, directory, block, first_of_all, out = uuid.uuid4().hex, [], [], None, None

        def flush() -> None:
            data = gzip.compress("\n".join(block).encode(), mtime=0)
            directory.append(f"{block[0].rsplit(chr(9), 3)[0]}\t{out.tell()}\t{len(data)}")
            out.write(data)
            block.clear()

        for batch in batches:
            for k, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    filesystem.create_dir(f"{base}/index", recursive=True)
                    out, first_of_all = filesystem.open_output_stream(f"{base}/index/{name}.cdx.gz", compression=None), k
                block.append(f"{k}\t{file}\t{offset}\t{length}")
                if len(block) >= BLOCK_LINES:
                    flush()
        if out is not None:
            if block:
                flush()
            out.close()
            with filesystem.open_output_stream(f"{base}/index/{name}.dir", compression=None) as d:
                d.write("\n".join(directory).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([first_of_all]), pa.array([f"index/{name}.cdx.gz"]), pa.array([f"index/{name}.dir"])], names=["first", "file", "directory"]
            )

    made = materialise(ordered.mapInArrow(write, "first string, file string, directory string"))
    return CaptureIndex(root, tuple(sorted((r["first"].encode(), r["file"], r["directory"]) for r in made.collect())))


class _Reader:
    """Binary search in an index; keeps the last directory and the last block."""

    def __init__(self, index: CaptureIndex):
        self.index, (self.filesystem, self.base) = index, _filesystem(index.root)
        self.firsts = [f[0] for f in index.files]
        self.kept: dict[str, tuple] = {}

    def _range(self, file: str, offset: int, length: int) -> bytes:
        if self.kept.get("open", ("",))[0] != file:
            self.kept["open"] = (file, self.filesystem.open_input_file(f"{self.base}/{file}"))
        return self.kept["open"][1].read_at(length, offset)

    def _directory(self, i: int) -> list[tuple[bytes, int, int]]:
        if self.kept.get("directory", (None,))[0] != i:
            with self.filesystem.open_input_file(f"{self.base}/{self.index.files[i][2]}") as f:
                rows = [line.rsplit(b"\t", 2) for line in f.readall().split(b"\n")]
            self.kept["directory"] = (i, [(k, int(o), int(n)) for k, o, n in rows])
        return self.kept["directory"][1]

    def _block(self, i: int, offset: int, length: int) -> list[list[bytes]]:
        if self.kept.get("block", (None,))[0] != (i, offset):
            lines = zlib.decompress(self._range(self.index.files[i][1], offset, length), wbits=31).split(b"\n")
            self.kept["block"] = ((i, offset), [line.rsplit(b"\t", 3) for line in lines])
        return self.kept["block"][1]

    def find(self, key: bytes) -> Iterator[tuple[str, int, int]]:
        """All captures whose key and page are ``key``; with ``key`` ending in a tab, all pages of the URL."""
        prefix = key.endswith(b"\t")

        def matches(k: bytes) -> bool:
            return k.startswith(key) if prefix else k == key

        # Equal keys may go on in later blocks and files, and begin in the one before.
        for i in range(max(0, bisect_left(self.firsts, key) - 1), len(self.firsts)):
            if self.firsts[i] > key and not matches(self.firsts[i]):
                return
            blocks = self._directory(i)
            firsts = [b[0] for b in blocks]
            for first, offset, length in blocks[max(0, bisect_left(firsts, key) - 1) :]:
                if first > key and not matches(first):
                    return
                lines = self._block(i, offset, length)
                for line in lines[bisect_left(lines, key, key=lambda x: x[0]) :]:
                    if not matches(line[0]):
                        break
                    yield line[1].decode(), int(line[2]), int(line[3])


def look_up(wanted: DataFrame, index: CaptureIndex) -> DataFrame:
    """``file, offset, length`` of the captures of each distinct ``key, page``; a null ``key`` row asks for nothing.

    Requests are sorted like the index, so a task reads neighbouring blocks, each once.
    """
    keys = wanted.select(_entry_key().alias("k")).distinct().repartitionByRange("k").sortWithinPartitions("k")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(index)
        for batch in batches:
            got = [hit for k in batch.column(0).to_pylist() for hit in reader.find(k.encode())]
            columns = list(zip(*got, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["file", "offset", "length"])

    return keys.mapInArrow(find, "file string, offset bigint, length bigint")


def captures_of_url(index: CaptureIndex, url: str | None) -> list[dict]:
    """All records of one URL, read on the driver: fields and payload."""
    reader = _Reader(index)
    hits = list(reader.find(url_key(url).encode() + b"\t"))
    return [{"warc": w, "http": h, "payload": p} for w, h, p in (parse(reader._range(*hit)) for hit in hits)]


def read_records(places: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """Range-read records at stored ``places``: ``page, payload_bytes, payload_digest, record_type, refers_to`` (and ``payload``).

    The digest of a response is computed from what was read, and must be the recorded one.
    """
    schema = "page string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + (", payload binary" if with_payload else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        reader = _Reader(CaptureIndex(root, ()))
        name = lambda text: unquote(text[len("<urn:x-page:") : -1]) or None
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                warc, http, payload = parse(reader._range(*place))
                kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
                size = int(http["content-length"])
                if kind == "response" and (digest_of(payload) != digest or len(payload) != size):
                    raise ValueError(f"damaged record at {place}")
                refers = name(warc["warc-refers-to"]) if kind == "revisit" else None
                for column, value in zip(rows, (name(warc["warc-record-id"]), size, digest, kind, refers, payload), strict=True):
                    column.append(value)
            arrays = [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), *(pa.array(r, pa.string()) for r in rows[2:5])]
            names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            if with_payload:
                arrays, names = [*arrays, pa.array(rows[5], pa.binary())], [*names, "payload"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    total = places.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    parts = max(places.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES)
    ordered = places.repartitionByRange(int(parts), "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(read, schema)


def op6_two_level_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC files and read back through the capture index."""
    pages, root = load(spark, sf_dir, "pages"), scratch_dir(spark)
    captures = write_archive(pages, root)
    index = build_index(captures, root)
    found = materialise(look_up(captures.select("key", "page"), index))
    id_type = pages.schema["page_id"].dataType
    return read_records(found, root).select(
        F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to")
    )


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_page FROM pages
),
bits AS (
  SELECT *, array_to_string(list_transform(regexp_extract_all(sha1(html), '.'), lambda h: lpad(bin(('0x' || h)::INTEGER), 4, '0')), '') AS b
  FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    list_sum(list_transform(range(5), lambda j: substr(b, 5 * k + j + 1, 1)::INTEGER * (16 >> j)))::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM bits
"""
