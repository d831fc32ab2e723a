"""Documents sent in bulks to a target that may refuse or fail."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loglathe import append_rows, error_events, read_refused, read_refused_documents, refusal_reasons, send_documents, to_documents, traffic, wait_all


def target(folder, refuse=(), fail=None):
    """A file per document id; pages in ``refuse`` are refused, a file ``fail`` makes every bulk fail."""
    folder, refuse, fail = str(folder), tuple(refuse), str(fail) if fail else None

    def send(bulk):
        import json
        import os

        if fail and os.path.exists(fail):
            raise OSError("target is away")
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/bulks", "a") as file:
            file.write(f"{len(bulk)}\n")
        refused = []
        for place, (doc_id, document) in enumerate(bulk):
            if json.loads(document).get("url") in refuse:
                refused.append((place, f"no such page: {json.loads(document)['url']}"))
            else:
                with open(f"{folder}/{doc_id}.doc", "w") as file:
                    file.write(document)
        return refused

    return send


def taken(folder):
    return sorted((json.loads(f.read_text()) for f in Path(folder).glob("*.doc")), key=str)


def refused(spark, root):
    return sorted((json.loads(r["document"])["ip"], r["reason"], r["batch_id"]) for r in read_refused_documents(spark, "error_logs", root).collect())


@pytest.fixture
def errors(events):
    return lambda *rows: error_events(events(*[(ip, "2024-01-01 00:00:00", url, 404) for ip, url in rows]))


def test_reasons_and_counts(spark, errors, tmp_path):
    root = str(tmp_path / "root")
    rows = errors(*[(f"c{i}", "/bad" if i % 5 == 0 else "/x") for i in range(23)]).coalesce(1)
    assert send_documents(rows, "error_logs", target(tmp_path / "t", ["/bad"]), root, 0, bulk=4) == (18, 5)
    assert refused(spark, root) == sorted((f"c{i}", "no such page: /bad", 0) for i in range(0, 23, 5))
    assert sorted(d["ip"] for d in taken(tmp_path / "t")) == sorted(f"c{i}" for i in range(23) if i % 5)
    assert set(taken(tmp_path / "t")[0]) == {"ip", "timestamp", "url", "status_code", "method", "log_type", "processed_at"}
    assert (tmp_path / "t" / "bulks").read_text().split() == ["4"] * 5 + ["3"]


def test_replay_replaces_what_was_refused(spark, errors, tmp_path):
    root, rows = str(tmp_path / "root"), errors(("a", "/x"), ("b", "/y"), ("b", "/y"))
    assert send_documents(rows, "error_logs", target(tmp_path / "t", ["/y"]), root, 3) == (1, 2)
    assert send_documents(rows, "error_logs", target(tmp_path / "t", ["/x"]), root, 3) == (2, 1)
    assert refused(spark, root) == [("a", "no such page: /x", 3)]
    assert len(taken(tmp_path / "t")) == 2  # equal rows are one document
    assert send_documents(rows, "error_logs", target(tmp_path / "t"), root, 3) == (3, 0)
    assert refused(spark, root) == []


def test_failing_target_leaves_nothing_and_the_stream_sends_again(spark, tmp_path):
    schema = "ip string, timestamp timestamp, url string, status_code int, method string"
    at = F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp")

    def add(*urls):
        rows = spark.createDataFrame([(u, u) for u in urls], "ip string, url string")
        rows.select("ip", at, "url", F.lit(404).alias("status_code"), F.lit("GET").alias("method")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    root, away = str(tmp_path / "root"), tmp_path / "away"

    def run():
        stream = error_events(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        send = target(tmp_path / "t", ["/bad"], away)
        wait_all(spark, {"d": to_documents(stream, "error_logs", send, root, f"{tmp_path}/cp", available_now=True)})

    add("/x", "/bad")
    run()
    add("/y", "/bad", "/z")
    away.touch()
    with pytest.raises(Exception, match="target is away"):
        run()
    assert [r[2] for r in refused(spark, root)] == [0]
    away.unlink()
    run()
    assert refused(spark, root) == [("/bad", "no such page: /bad", 0), ("/bad", "no such page: /bad", 1)]
    assert [d["url"] for d in taken(tmp_path / "t")] == ["/x", "/y", "/z"]


def test_newest_version_of_a_key_stays(spark, events, tmp_path):
    root = str(tmp_path / "root")
    for n, count in enumerate((1, 2)):
        rows = traffic(events(*[("a", "2024-01-01 00:00:00", "/x", 200)] * count))
        assert send_documents(rows, "traffic_by_minute", target(tmp_path / "t"), root, n) == (1, 0)
    assert [d["request_count"] for d in taken(tmp_path / "t")] == [2]


def test_empty_and_null(spark, errors, tmp_path):
    root = str(tmp_path / "root")
    assert send_documents(errors((None, None)).limit(0), "error_logs", target(tmp_path / "t"), root, 0) == (0, 0)
    assert send_documents(errors((None, None)), "error_logs", target(tmp_path / "t", [None]), root, 1) == (0, 1)
    assert refused(spark, root) == [(None, "no such page: None", 1)]


def test_first_misfit_is_named(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2024-01-01", "/", "404"), ("b", "2024-01-01", "/", "x"), ("c", "when", "/", "y"), ("d", None, "/", None)],
        "ip string, timestamp string, url string, status_code string",
    ).withColumns({"method": F.lit("GET"), "log_type": F.lit("error")})
    root = str(tmp_path / "tables")
    assert append_rows(df, "error_logs", root) == (2, 2)
    found = refusal_reasons(read_refused(spark, "error_logs", root), "error_logs")
    assert found.columns == ["document", "batch_id", "field", "value", "expected"]
    named = {json.loads(r["document"])["ip"]: (r["field"], r["value"], r["expected"]) for r in found.collect()}
    assert named == {"b": ("status_code", "x", "int"), "c": ("timestamp", "when", "timestamp")}
    other = spark.createDataFrame([('{"ip":"e","status_code":404}',)], "document string")
    assert refusal_reasons(other, "error_logs").first()["field"] is None
