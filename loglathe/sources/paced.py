"""Log files as a stream of a fixed number of lines per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import strip

PIECE = 1 << 20


def _paced_lines():
    """The data source. Made inside a function, so that it travels by value and workers need no library."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    block_size = 1 << 20

    def opened(path):
        from pyarrow import fs

        if path.startswith("file:"):
            path = "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)

    def listed(path):
        """(time, path, size) of the files below a folder, oldest first; hidden ones are left out."""
        from pyarrow import fs

        filesystem, base = opened(path)
        found = filesystem.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        files = [f for f in found if f.is_file and not any(p[:1] in "_." for p in f.path[len(base):].split("/") if p)]
        return filesystem, sorted((f.mtime_ns, f.path, f.size) for f in files)

    def lines_from(file, position, end):
        """(end position, line) of the lines that start at ``position`` or later, but before ``end``."""
        file.seek(position)
        rest = b""
        while position < end:
            block = file.read(block_size)
            if not block:
                if rest:
                    yield position + len(rest), rest
                return
            parts = (rest + block).split(b"\n") if b"\n" in block else [rest + block]
            rest = parts.pop()
            for part in parts:
                if position >= end:
                    return
                position += len(part) + 1
                yield position, part

    class Piece(InputPartition):
        def __init__(self, path, start, end, first):
            self.path, self.start, self.end, self.first = path, start, end, first

    class Reader(DataSourceStreamReader):
        """An offset names the last file, the position in it, and the stretches of files of its own batch."""

        def __init__(self, options):
            self.folder, self.lines, self.piece = options["path"], int(options["lines"]), int(options["piece"])
            self.at = None

        def initialOffset(self):
            return {"time": 0, "file": "", "position": 0, "stretches": []}

        def latestOffset(self):
            at = self.at = self.at or self.initialOffset()
            filesystem, files = listed(self.folder)
            wanted, stretches = self.lines, []
            for time, path, size in files:
                if (time, path) < (at["time"], at["file"]):
                    continue
                start = at["position"] if path == at["file"] else 0
                if start >= size:
                    continue
                end = start
                with filesystem.open_input_file(path) as file:
                    for end, line in lines_from(file, start, size):
                        wanted -= bool(line.strip())
                        if not wanted:
                            break
                stretches.append([path, start, end])
                self.at = {"time": time, "file": path, "position": end, "stretches": stretches}
                if not wanted:
                    break
            return self.at

        def partitions(self, start, end):
            # After a restart Spark names the last offset here before it asks for the next.
            self.at = self.at or end
            if start == end:
                return []
            cuts = [(path, low, high, at) for path, low, high in end["stretches"] for at in range(low, high, self.piece)]
            return [Piece(path, at, min(at + self.piece, high), at == low) for path, low, high, at in cuts]

        def read(self, partition):
            # A piece has the lines that start in it; the one that runs into it belongs to the piece before.
            with opened(self.folder)[0].open_input_file(partition.path) as file:
                position = partition.start
                if not partition.first:
                    position, _ = next(lines_from(file, position - 1, position))
                for _, line in lines_from(file, position, partition.end):
                    yield (line.decode("utf-8", "replace"),)

        def commit(self, end):
            pass

    class PacedLines(DataSource):
        @classmethod
        def name(cls):
            return "paced_lines"

        def schema(self):
            return "value string"

        def streamReader(self, schema):
            return Reader(self.options)

    return PacedLines


def read_paced_lines(spark: SparkSession, path: str, lines_per_batch: int, piece_bytes: int = PIECE) -> DataFrame:
    """Non-blank lines below a folder as a stream, ``lines_per_batch`` in each batch, stripped, as ``raw_log``.

    A batch goes on over the ends of files, oldest file first, and all but the last one is full. Offsets
    hold positions in files and the stretches that a batch reads, so a restart goes on with the next line and a replay reads
    the same ones. The driver only looks for the end of a batch, tasks read pieces of ``piece_bytes``.
    Files must be complete when they appear, not compressed, and not older than those already read, else they are left out.
    An ``availableNow`` start reads one batch.
    """
    if lines_per_batch < 1:
        raise ValueError("a batch needs at least one line")
    spark.dataSource.register(_paced_lines())
    reader = spark.readStream.format("paced_lines").option("lines", lines_per_batch).option("piece", piece_bytes)
    return reader.option("path", path).load().select(strip(F.col("value")).alias("raw_log")).filter(F.col("raw_log") != "")
