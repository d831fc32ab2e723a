import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglathe import decode_kafka, kafka_read_options, kafka_write_options, load_json_results, read_log_files, write_kafka


def test_read_log_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"  one \n\n\t\ntwo\r\n\xa0three \xff\n")
    (tmp_path / "b.log").write_text("four\n")
    found = sorted(row["raw_log"] for row in read_log_files(spark, str(tmp_path)).collect())
    assert found == ["four", "one", "three \ufffd", "two"]
    assert read_log_files(spark, str(tmp_path), max_lines=2).count() == 2
    assert read_log_files(spark, str(tmp_path), max_lines=0).count() == 4
    with pytest.raises(ValueError):
        read_log_files(spark, str(tmp_path), max_lines=2, streaming=True)


def test_stream_of_log_files_is_paced(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for i in range(4):
        (logs / f"{i}.log").write_text(f"line {i}\n\n")
    df = read_log_files(spark, str(logs), streaming=True, max_files_per_trigger=1)
    sizes = []
    query = (
        df.writeStream.foreachBatch(lambda batch, n: sizes.append(batch.count()))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    assert sizes == [1, 1, 1, 1]


def write_documents(folder, *lines):
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("\n".join(lines) + "\n")
    (folder / "notes.txt").write_text('{"ip": "not read"}\n')


ERROR = {"ip": "1.2.3.4", "timestamp": "1995-07-01T00:00:12", "url": "/x", "status_code": 404, "method": "GET", "log_type": "error"}


def test_json_results(spark, tmp_path, caplog):
    write_documents(
        tmp_path / "error_logs",
        json.dumps(ERROR),
        "",
        "{broken",
        "3",
        json.dumps({**ERROR, "status_code": "404", "timestamp": 804556812000, "other": [1]}),
        json.dumps({**ERROR, "status_code": "x"}),
    )
    write_documents(
        tmp_path / "top_ips", '{"window_start":"2024-01-01T00:02:00.000Z","ip":"a","request_count":3,"log_type":"top_ips"}'
    )
    frames = load_json_results(spark, str(tmp_path))
    assert set(frames) == {"error_logs", "top_ips"}
    assert "traffic_by_minute" in caplog.text
    errors = frames["error_logs"].withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).collect()
    assert [(r["status_code"], r["timestamp"], r["ip"]) for r in errors] == [
        (404, datetime(1995, 7, 1, 0, 0, 12), "1.2.3.4"),
        (404, datetime(1995, 7, 1, 0, 0, 12), "1.2.3.4"),
        (None, datetime(1995, 7, 1, 0, 0, 12), "1.2.3.4"),
    ]
    assert frames["error_logs"].count() == 3
    assert frames["top_ips"].first()["request_count"] == 3


def test_streamed_json_results_load_each_file_once(spark, tmp_path):
    folder = tmp_path / "in" / "error_logs"
    write_documents(folder, json.dumps(ERROR))
    seen = []

    def run():
        df = load_json_results(spark, str(tmp_path / "in"), streaming=True)["error_logs"]
        df.writeStream.foreachBatch(lambda batch, n: seen.extend(batch.collect())).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start().awaitTermination(60)

    run()
    (folder / "part-1.json").write_text(json.dumps({**ERROR, "url": "/y"}) + "\n")
    run()
    run()
    assert [row["url"] for row in seen] == ["/x", "/y"]


def test_kafka_options(spark):
    assert kafka_read_options(["a:1", "b:2"], "logs", starting="earliest", max_offsets_per_trigger=5, min_partitions=9) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "logs",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
        "minPartitions": "9",
    }
    assert kafka_read_options("a:1", "logs")["startingOffsets"] == "latest"
    assert kafka_write_options("a:1", "logs") == {
        "kafka.bootstrap.servers": "a:1",
        "topic": "logs",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
    }
    stream = spark.readStream.format("rate").load().select(F.lit("k").alias("key"), F.lit("v").alias("value"))
    with pytest.raises(ValueError):
        write_kafka(stream, "a:1", "logs")


def test_decode_kafka(spark):
    df = spark.createDataFrame(
        [(bytearray("é - -".encode()), 1, 7)], "value binary, partition int, offset long"
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    assert decode_kafka(df).columns == ["raw_log", "kafka_timestamp"]
    row = decode_kafka(df, keep_position=True).first()
    assert (row["raw_log"], row["kafka_partition"], row["kafka_offset"]) == ("é - -", 1, 7)
