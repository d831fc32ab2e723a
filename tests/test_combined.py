"""Four analyses from one parse, against the batch operators and Spark's own watermark."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loglathe import combined_progress, parse_clf, read_combined, read_latest, read_log_files, start_all, to_combined, traffic, wait_all
from loglathe.streaming import ANALYSES, analysis_frames
from loglathe.streaming import combined as module

DAY = dt.datetime(2024, 1, 1)


class Logs:
    def __init__(self, spark, base):
        self.spark, self.base, self.count = spark, base, 0
        (base / "logs").mkdir()

    def add(self, *rows):
        """Rows (minute of the day, client, page, status) as one file."""
        text = "".join(
            f'{ip} - - [{(DAY + dt.timedelta(minutes=at)).strftime("%d/%b/%Y:%H:%M:%S")} +0000] "GET {url} HTTP/1.0" {status} 1\n' for at, ip, url, status in rows
        )
        (self.base / "logs" / f"{self.count}.log").write_text(text)
        self.count += 1

    def lines(self, **options):
        return read_log_files(self.spark, str(self.base / "logs"), **options)

    def run(self, name="combined", **options):
        query = to_combined(parse_clf(self.lines(streaming=True)), f"{self.base}/{name}", f"{self.base}/{name}-cp", available_now=True, **options)
        wait_all(self.spark, {"combined": query})
        return f"{self.base}/{name}"


@pytest.fixture
def logs(spark, tmp_path):
    return Logs(spark, tmp_path)


def rows(df):
    plain = [F.col(n).cast("string") if t == "timestamp" else n for n, t in df.drop("processed_at").dtypes]
    return sorted(map(tuple, df.select(*plain).collect()), key=repr)


def late(spark, root):
    return {r["analysis"]: (r["late_rows"], r["total_late_rows"]) for r in combined_progress(spark, root).collect()}


def test_equals_batch_over_restarts(spark, logs):
    rng = random.Random(1)
    entries = sorted((rng.random() * 60, f"10.0.0.{rng.randrange(5)}", f"/{rng.choice('abc')}", rng.choice((200, 200, 404, 500))) for _ in range(600))
    for part in (entries[:200], entries[200:400], entries[400:]):
        logs.add(*part)
        root = logs.run()
    events = parse_clf(logs.lines())
    for name, frame in analysis_frames(events).items():
        assert rows(read_combined(spark, root, name)) == rows(frame), name
    assert late(spark, root) == dict.fromkeys(module.COUNTED, (0, 0))
    inside = read_combined(spark, root, "traffic_by_minute", since="2024-01-01 00:10:00", until="2024-01-01 00:20:00")
    assert rows(inside) == [r for r in rows(traffic(events)) if "00:10" <= r[0][11:16] < "00:20"]


def test_late_rows_count_one_by_one_and_after_a_restart(spark, logs):
    logs.add((30, "a", "/x", 200))
    logs.run()
    # Five rows of one closed window, two of a window that is closed for minutes alone, one in time.
    logs.add(*[(5.1, "a", "/x", 404)] * 5, *[(26.5, "b", "/y", 200)] * 2, (27.5, "b", "/y", 200), (29, "b", "/y", 200), (40, "a", "/x", 200))
    root = logs.run()
    assert late(spark, root) == {"traffic_by_minute": (8, 8), "top_ips": (8, 8), "url_analysis": (8, 8)}
    logs.add((37.5, "a", "/x", 200), (36.9, "a", "/x", 200), (39, "a", "/x", 200))
    logs.run()
    # 37:30 is in the minute that ends with the watermark 38:00, as are its two minutes.
    assert late(spark, root) == {"traffic_by_minute": (2, 10), "top_ips": (2, 10), "url_analysis": (2, 10)}
    assert [r[0][11:16] for r in rows(read_combined(spark, root, "traffic_by_minute"))] == ["00:29", "00:30", "00:39", "00:40"]
    assert read_combined(spark, root, "error_logs").count() == 5  # failed requests are never late
    first = combined_progress(spark, root).first()
    assert (first["batch_id"], first["input_rows"], first["total_rows"], str(first["watermark"])[11:16]) == (2, 3, 14, "00:38")


def test_widths_close_apart(spark, logs):
    """At a watermark inside a window of two minutes its first minute is closed, the window is not."""
    logs.add((31, "a", "/x", 200))
    logs.run()
    logs.add((28.5, "a", "/x", 200))
    root = logs.run()
    assert late(spark, root) == {"traffic_by_minute": (1, 1), "top_ips": (0, 0), "url_analysis": (0, 0)}


def test_keeps_what_the_separate_queries_keep(spark, logs, tmp_path):
    """The same rows as four queries with Spark's watermark, late lines among them."""
    for part in ([(30, "a", "/x", 200)], [(31, "a", "/x", 200)], [(5, "a", "/x", 404), (31.5, "b", "/x", 200), (34, "a", "/x", 200)]):
        logs.add(*part)
        events = parse_clf(logs.lines(streaming=True))
        wait_all(spark, start_all(events, f"{tmp_path}/tables", f"{tmp_path}/cps", available_now=True, state_partitions=2))
        root = logs.run()
    for name in ANALYSES:
        assert rows(read_combined(spark, root, name)) == rows(read_latest(spark, name, f"{tmp_path}/tables")), name


def test_replayed_batch_replaces_itself(spark, logs, monkeypatch):
    logs.add((1, "a", "/x", 404), (2, "b", "/y", 200))
    logs.run()
    logs.add((3, "a", "/x", 404), (3.5, "a", "/x", 500))
    write = module.paths.write_text

    def broken(spark, path, text):
        if path.endswith("progress/1"):
            raise OSError("disk full")
        return write(spark, path, text)

    monkeypatch.setattr(module.paths, "write_text", broken)
    with pytest.raises(Exception, match="disk full"):
        logs.run()
    root = f"{logs.base}/combined"
    # All of the batch but its progress is stored: it does not count yet.
    assert read_combined(spark, root, "error_logs").count() == 1
    assert read_combined(spark, root, "traffic_by_minute").count() == 2
    monkeypatch.setattr(module.paths, "write_text", write)
    logs.run()
    for name, frame in analysis_frames(parse_clf(logs.lines())).items():
        assert rows(read_combined(spark, root, name)) == rows(frame), name


def test_nulls_ties_and_empty_batches(spark, tmp_path):
    schema = "ip string, timestamp timestamp, url string, status_code int, method string, extra int"
    at = DAY + dt.timedelta(minutes=1)
    root = str(tmp_path / "combined")
    assert combined_progress(spark, root).count() == 0 and read_combined(spark, root, "top_ips").count() == 0
    module.write_combined(spark.createDataFrame([(None, at, None, None, None, 1)] * 2 + [("a", None, "/x", 500, "GET", 1)], schema), 0, root)
    module.write_combined(spark.createDataFrame([], schema), 1, root)
    assert [r["request_count"] for r in read_combined(spark, root, "traffic_by_minute").collect()] == [2]
    assert [(r["ip"], r["request_count"]) for r in read_combined(spark, root, "top_ips").collect()] == [(None, 2)]
    assert [(r["ip"], r["timestamp"]) for r in read_combined(spark, root, "error_logs").collect()] == [("a", None)]
    state = combined_progress(spark, root).first()
    assert (state["batch_id"], state["input_rows"], state["total_rows"], state["total_late_rows"]) == (1, 0, 3, 0)
    with pytest.raises(ValueError, match="lacks batch"):
        module.write_combined(spark.createDataFrame([], schema), 7, root)
    with pytest.raises(ValueError, match="none of"):
        read_combined(spark, root, "rejects")


def test_root_and_checkpoint_belong_together(spark, logs, tmp_path):
    logs.add((1, "a", "/x", 404))
    root = logs.run()
    with pytest.raises(ValueError, match="belongs to query"):
        to_combined(parse_clf(logs.lines(streaming=True)), root, str(tmp_path / "fresh"), available_now=True)


def test_source_is_read_once_a_batch(spark, logs, monkeypatch):
    """The three jobs of a batch share one evaluation of the parsed rows."""
    plans = []
    write = module.write_combined

    def spy(batch, batch_id, root, watermark):
        reads = spark.sparkContext.accumulator(0)
        counting = batch.filter(F.udf(lambda _: reads.add(1) or True, "boolean")("ip"))
        write(counting, batch_id, root, watermark)
        plans.append(reads.value)

    monkeypatch.setattr(module, "write_combined", spy)
    logs.add(*[(i / 60, "a", "/x", 404) for i in range(100)])
    logs.run()
    assert plans == [100]
