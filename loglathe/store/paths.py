"""Folder names of the result store and the few file-system calls it needs."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder with its content; False if there is none."""
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True) if fs.exists(hadoop_path) else False


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target's parent is created, the target must not exist."""
    fs, hadoop_path = _fs(spark, source)
    to = _fs(spark, target)[1]
    fs.mkdirs(to.getParent())
    if fs.exists(hadoop_path) and not fs.rename(hadoop_path, to):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small marker file, None if it is missing."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return None
    # Not through a reader: Spark skips files whose name starts with "_".
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists already."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        return bool(fs.createNewFile(hadoop_path))
    except Py4JJavaError:
        if fs.exists(hadoop_path):
            return False
        raise


def numbered(spark: SparkSession, parent: str, label: str, finished: bool = True) -> list[int]:
    """Numbers n of the folders ``<parent>/<label>=<n>``, ascending; only finished ones by default."""
    mark = "/_SUCCESS" if finished else ""
    fs, pattern = _fs(spark, f"{parent}/{label}=*{mark}")
    found = fs.globStatus(pattern) or []
    matches = (re.search(rf"/{label}=(-?\d+){mark}$", str(status.getPath())) for status in found)
    return sorted(int(match.group(1)) for match in matches if match)


def numbered_files(spark: SparkSession, parent: str) -> list[int]:
    """Numbers n of the files ``<parent>/<n>``, ascending."""
    fs, pattern = _fs(spark, f"{parent}/*")
    found = fs.globStatus(pattern) or []
    matches = (re.search(r"/(-?\d+)$", str(status.getPath())) for status in found)
    return sorted(int(match.group(1)) for match in matches if match)


def days(spark: SparkSession, parent: str) -> list[str]:
    """Days d of the folders ``<parent>/dt=<d>``, ascending; rows without a day have Spark's default name."""
    fs, pattern = _fs(spark, f"{parent}/dt=*")
    found = fs.globStatus(pattern) or []
    matches = (re.search(r"/dt=(\d{4}-\d{2}-\d{2}|__HIVE_DEFAULT_PARTITION__)$", str(status.getPath())) for status in found)
    return sorted(match.group(1) for match in matches if match)
