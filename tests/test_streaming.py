import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import TimestampType

from loglathe import (
    error_events,
    last_batch,
    parse_clf,
    read_events,
    read_latest,
    read_log_files,
    search_index_options,
    start_all,
    status,
    stop_all,
    table_path,
    to_connector,
    to_console,
    to_files,
    to_table,
    traffic,
    wait_all,
    write_batch,
)
from loglathe.store import paths
from loglathe.streaming import ANALYSES, analysis_frames, job, sinks
from loglathe.store import tables


class Logs:
    """A folder of log files, each written later than the one before."""

    def __init__(self, folder):
        self.folder, self.count = folder, 0
        folder.mkdir()

    def add(self, *entries):
        text = "".join(f'{ip} - - [{ts}] "GET {url} HTTP/1.0" {status} 1\n' for ip, ts, url, status in entries)
        (self.folder / f"{self.count}.log").write_text(text)
        self.count += 1
        time.sleep(0.02)

    def stream(self, spark, **kwargs):
        return parse_clf(read_log_files(spark, str(self.folder), streaming=True, max_files_per_trigger=1), **kwargs)

    def batch(self, spark, **kwargs):
        return parse_clf(read_log_files(spark, str(self.folder)), **kwargs)


def at(minute, second=0, hour=0):
    return f"01/Jan/2024:{hour:02d}:{minute:02d}:{second:02d} +0000"


@pytest.fixture
def logs(tmp_path):
    return Logs(tmp_path / "logs")


@pytest.fixture
def where(tmp_path):
    return str(tmp_path / "tables"), str(tmp_path / "checkpoints")


def rows(df):
    naive = [F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, TimestampType) else f.name for f in df.schema.fields]
    return sorted(map(tuple, df.drop("processed_at").select(*naive[: len(df.drop("processed_at").columns)]).collect()), key=str)


def run(spark, events, where, **kwargs):
    queries = start_all(events, *where, available_now=True, state_partitions=2, **kwargs)
    wait_all(spark, queries)
    return queries


def test_stream_equals_batch_over_restarts(spark, logs, where):
    logs.add(("a", at(0, 1), "/x", 200), ("b", at(0, 30), "/y", 404))
    logs.add(("a", at(1, 59), "/x", 500), ("a", at(2, 0), "/x", 200))
    run(spark, logs.stream(spark), where)
    logs.add(("b", at(1, 58), "/y", 200), ("a", at(2, 1), "/z", 403))  # still in time
    logs.add(("c", at(40), "/x", 200))
    queries = run(spark, logs.stream(spark), where)
    for name, frame in analysis_frames(logs.batch(spark)).items():
        assert rows(read_latest(spark, name, where[0])) == rows(frame), name
    assert last_batch(spark, where[0], "error_logs") == 2  # the last file had no error
    state = {r["name"]: r for r in status(spark, list(queries.values())).collect()}
    assert set(state) == set(ANALYSES)
    assert not any(r["active"] for r in state.values())
    assert {r["late_groups"] for r in state.values()} == {0}


def test_late_rows_are_dropped_and_counted(spark, logs, where):
    logs.add(("a", at(30), "/x", 200))
    logs.add(("a", at(31), "/x", 200))
    logs.add(("a", at(5), "/x", 200), ("a", at(32), "/x", 200))
    queries = run(spark, logs.stream(spark), where, analyses=["traffic_by_minute"])
    minutes = [r[0].minute for r in rows(read_latest(spark, "traffic_by_minute", where[0]))]
    assert minutes == [30, 31, 32]
    assert status(spark, list(queries.values())).first()["late_groups"] == 1


@pytest.mark.parametrize("mode,dropped", [("reject", 0), ("now", 2)])
def test_bad_time_moves_the_watermark_only_when_asked_to(spark, logs, where, mode, dropped):
    logs.add(("a", at(0), "/x", 200), ("a", "bad", "/x", 200))
    for minute in (1, 2, 3):
        logs.add(("a", at(minute), "/x", 200))
    queries = run(spark, logs.stream(spark, on_bad_ts=mode), where, analyses=["traffic_by_minute"])
    assert (status(spark, list(queries.values())).first()["late_groups"] > 0) == (dropped > 0)


def test_failing_write_stops_the_query_and_loses_nothing(spark, logs, where, monkeypatch):
    logs.add(("a", at(0), "/x", 404))
    logs.add(("b", at(1), "/x", 404))
    write = tables.write_batch

    def broken(df, analysis, root, batch_id, **kwargs):
        if batch_id == 1:
            raise RuntimeError("disk full")
        return write(df, analysis, root, batch_id, **kwargs)

    monkeypatch.setattr(sinks.tables, "write_batch", broken)
    queries = start_all(logs.stream(spark), *where, analyses=["traffic_by_minute", "error_logs"], available_now=True)
    with pytest.raises(Exception, match="disk full"):
        wait_all(spark, queries)
    assert not any(query.isActive for query in queries.values())
    monkeypatch.setattr(sinks.tables, "write_batch", write)
    run(spark, logs.stream(spark), where, analyses=["traffic_by_minute", "error_logs"])
    assert rows(read_latest(spark, "error_logs", where[0])) == rows(error_events(logs.batch(spark)))
    assert rows(read_latest(spark, "traffic_by_minute", where[0])) == rows(traffic(logs.batch(spark)))


def test_table_and_checkpoint_belong_together(spark, logs, where, tmp_path):
    logs.add(("a", at(0), "/x", 404))
    run(spark, logs.stream(spark), where, analyses=["error_logs"])
    with pytest.raises(ValueError, match="belongs to query"):
        to_table(error_events(logs.stream(spark)), "error_logs", where[0], str(tmp_path / "fresh"))
    with pytest.raises(ValueError, match="fed by a stream"):
        tables.append_rows(error_events(logs.batch(spark)), "error_logs", where[0])
    write_batch(traffic(logs.batch(spark)), "traffic_by_minute", where[0], 0)
    with pytest.raises(ValueError, match="another writer"):
        start_all(logs.stream(spark), *where, analyses=["error_logs", "traffic_by_minute"])
    assert spark.streams.active == []


def test_stop_all_and_status(spark, logs, where):
    logs.add(("a", at(0), "/x", 404))
    queries = start_all(logs.stream(spark), *where, trigger="1 second", analyses=["error_logs", "traffic_by_minute"])
    assert {(r["name"], r["active"]) for r in status(spark).collect()} == {("error_logs", True), ("traffic_by_minute", True)}
    for query in queries.values():
        query.processAllAvailable()
    assert stop_all(spark) == 2 and stop_all(spark) == 0
    assert status(spark).count() == 0
    assert rows(read_latest(spark, "error_logs", where[0])) == rows(error_events(logs.batch(spark)))


def test_json_sink(spark, logs, where):
    logs.add(("a", at(0), "/x", 404))
    logs.add(("a", at(0, 30), "/x", 404))
    run(spark, logs.stream(spark), where, fmt="json")
    for name, frame in analysis_frames(logs.batch(spark)).items():
        assert rows(read_latest(spark, name, where[0], fmt="json")) == rows(frame), name
    files = f"{table_path(where[0], 'error_logs')}/batches/batch_id=0"
    assert paths.exists(spark, files) and spark.read.json(files).count() == 1


def test_stored_events_share_one_parse(spark, logs, where, tmp_path):
    folder = str(tmp_path / "events")
    for minute in (0, 1, 5):
        logs.add(("a", at(minute), "/x", 200), ("b", at(minute, 9), "/y", 404))
        query = to_files(logs.stream(spark), folder, str(tmp_path / "cp"), available_now=True)
        assert query.awaitTermination(60) and query.exception() is None
        run(spark, read_events(spark, folder, streaming=True), where, analyses=["traffic_by_minute", "error_logs"])
    assert rows(read_events(spark, folder)) == rows(logs.batch(spark))
    for name, frame in analysis_frames(logs.batch(spark), ["traffic_by_minute", "error_logs"]).items():
        assert rows(read_latest(spark, name, where[0])) == rows(frame), name
    plan = traffic(read_events(spark, folder))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:timestamp>" in plan and "regexp" not in plan


def test_console(spark, logs):
    logs.add(("a", at(0), "/x", 404))
    query = to_console(error_events(logs.stream(spark)), "errors_console", available_now=True)
    assert query.awaitTermination(60) and query.exception() is None


def folder_index():
    """A stand-in for a search index: one file per document id, the last write wins.

    Defined here so that it is sent to the workers by value.
    """

    class FolderIndexWriter(DataSourceWriter):
        def __init__(self, options, schema):
            self.folder, self.id, self.names = options["folder"], options["es.mapping.id"], schema.names

        def write(self, iterator):
            for row in iterator:
                document = dict(zip(self.names, row))
                with open(f"{self.folder}/{document[self.id]}", "w") as file:
                    file.write(str(document["request_count"]))
            return WriterCommitMessage()

    class FolderIndex(DataSource):
        @classmethod
        def name(cls):
            return "folder_index"

        def writer(self, schema, overwrite):
            return FolderIndexWriter(self.options, schema)

    return FolderIndex


def test_connector_gets_one_document_per_key(spark, logs, tmp_path):
    spark.dataSource.register(folder_index())
    index = tmp_path / "index"
    index.mkdir()
    options = {**search_index_options("http://search:9200", "web-logs-traffic"), "folder": str(index)}
    assert options["es.nodes"] == "search:9200" and options["es.resource"] == "web-logs-traffic"
    logs.add(("a", at(0, 1), "/x", 200), ("a", at(1, 1), "/x", 200))
    logs.add(("a", at(0, 2), "/x", 200))
    query = to_connector(
        traffic(logs.stream(spark)), "traffic_by_minute", "folder_index", options, str(tmp_path / "cp"),
        available_now=True, state_partitions=2,
    )
    query.awaitTermination(120)
    assert query.exception() is None
    assert sorted(file.read_text() for file in index.iterdir()) == ["1", "2"]


def test_document_ids_use_the_position_in_the_topic(spark, logs):
    logs.add(("a", at(0), "/x", 404), ("a", at(0), "/x", 404))
    errors = error_events(logs.batch(spark)).coalesce(1)
    assert sinks.with_document_id(errors, "error_logs").select("doc_id").distinct().count() == 1
    placed = errors.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.monotonically_increasing_id()})
    assert sinks.with_document_id(placed, "error_logs").select("doc_id").distinct().count() == 2
    assert job.analysis_frames(placed.withColumn("method", F.lit("GET")), ["error_logs"])["error_logs"].columns[-3:] == [
        "kafka_partition", "kafka_offset", "log_type"
    ]
