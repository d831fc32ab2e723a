"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the jobs need beyond Spark's defaults. Adaptive execution, partition
# coalescing and skew-join splitting are on by default and stay so.
JOB_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    # Window and client keys of a busy site outgrow the executor heap; RocksDB
    # keeps state on local disk and uploads only changelogs per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "loglathe", **conf: str) -> SparkSession:
    """A session for the jobs; master, memory and jars belong to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Time buckets and calendar fields follow the session zone: pin it to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def conf_values(spark: SparkSession, **values):
    """Set SQL options for the duration of a block (dots written as ``__``)."""
    names = {key.replace("__", "."): value for key, value in values.items() if value is not None}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, str(value))
    try:
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared one named in ``spark.checkpoint.dir``, removed when the driver ends.

    Only a local master may go without the setting; a cluster job needs storage
    that every executor sees, so it fails here instead of writing to one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="loglathe-")
    path = f"{shared.rstrip('/')}/loglathe-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the scratch folder and read it back.

    Survives lost executors, and gives the planner the true size of the data, so
    Spark's own threshold decides whether a later join may broadcast it. The folder goes
    when the driver ends, as results that read it may be used until then.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a batch input evenly over all cores, and over as many tasks as it has splits.

    For inputs Spark cannot split, such as gzip files or one row group, and work
    that costs more than moving the rows. The number of splits says nothing about
    where the rows are: a large file of one row group has many splits, all empty
    but one. So the rows are always dealt round robin.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, df.rdd.getNumPartitions()))
