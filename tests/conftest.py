import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("loglathe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Text lines to a frame with the column raw_log."""
    return lambda *texts: spark.createDataFrame([(text,) for text in texts], "raw_log string")


@pytest.fixture
def events(spark):
    """(ip, time, url, status) tuples to a frame of parsed events."""
    from pyspark.sql import functions as F

    def make(*rows):
        df = spark.createDataFrame(rows, "ip string, timestamp string, url string, status_code int")
        return df.select(
            "ip",
            F.col("timestamp").cast("timestamp").alias("timestamp"),
            F.lit("GET").alias("method"),
            "url",
            F.lit("HTTP/1.1").alias("protocol"),
            "status_code",
            F.lit(10).cast("bigint").alias("content_size"),
        )

    return make


def plan_of(df) -> str:
    """The executed plan, after a run where adaptive execution may change it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
