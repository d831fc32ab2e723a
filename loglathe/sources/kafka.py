"""Topics in and out. The connector jar comes with spark-submit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Delivery settings of the producer.
PRODUCER_OPTIONS: dict[str, str] = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
}


def _server_list(servers: str | list[str]) -> str:
    return servers if isinstance(servers, str) else ",".join(servers)


def kafka_read_options(
    servers: str | list[str],
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": _server_list(servers),
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        # Lets several tasks share a topic partition that holds most of the data.
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, servers: str | list[str], topic: str, **settings) -> DataFrame:
    """A stream of topic rows; settings as in :func:`kafka_read_options`."""
    return spark.readStream.format("kafka").options(**kafka_read_options(servers, topic, **settings)).load()


def decode_kafka(df: DataFrame, keep_position: bool = False) -> DataFrame:
    """Topic rows as ``raw_log`` and ``kafka_timestamp``.

    ``keep_position`` adds ``kafka_partition`` and ``kafka_offset``, which tell
    two identical lines apart.
    """
    position = []
    if keep_position:
        position = [F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset")]
    return df.select(
        F.col("value").cast("string").alias("raw_log"), F.col("timestamp").alias("kafka_timestamp"), *position
    )


def kafka_write_options(servers: str | list[str], topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": _server_list(servers), "topic": topic, **PRODUCER_OPTIONS}


def write_kafka(
    df: DataFrame, servers: str | list[str], topic: str, checkpoint: str | None = None, **trigger
) -> StreamingQuery | None:
    """Publish ``key`` and ``value`` rows (see ``with_message_key``).

    A batch frame is written at once. A streaming one needs a checkpoint and
    returns its query; ``trigger`` holds arguments of ``DataStreamWriter.trigger``.
    """
    options = kafka_write_options(servers, topic)
    if not df.isStreaming:
        df.select("key", "value").write.format("kafka").options(**options).save()
        return None
    if not checkpoint:
        raise ValueError("a streaming write needs a checkpoint location")
    writer = df.select("key", "value").writeStream.format("kafka").options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
