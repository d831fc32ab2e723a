"""Live metrics against the batch operators and plain Python."""

import datetime as dt
import math
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loglathe import (
    live_spikes, merged, rank_error, read_rollup, read_summaries, roll_up, spikes, stored_percentiles, stored_top_k, to_rollups, to_summaries, top_error, top_k,
)
from loglathe.session import JOB_CONF, conf_values

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp, ip string, url string, content_size bigint"


@pytest.fixture(autouse=True)
def rocksdb(spark):
    with conf_values(spark, spark__sql__streaming__stateStore__providerClass=JOB_CONF["spark.sql.streaming.stateStore.providerClass"]):
        yield


@pytest.fixture
def traffic():
    rng = random.Random(3)
    rows = [(DAY + dt.timedelta(minutes=rng.random() * 600), f"10.0.0.{min(int(rng.expovariate(0.2)), 60)}", rng.choice("abc"), rng.randrange(5000)) for _ in range(2400)]
    rows += [(DAY + dt.timedelta(minutes=300 + rng.random()), "10.0.0.1", "b", 7) for _ in range(50)]
    rows = [r for r in rows if not 200 <= (r[0] - DAY).seconds // 60 < 230]  # an outage
    return sorted(rows)


@pytest.fixture
def folder(spark, tmp_path):
    """Rows that arrive as files, and a stream that reads them."""

    class Folder:
        path = tmp_path

        def add(self, rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

        def stream(self):
            return spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")

    return Folder()


def thirds(rows):
    n = len(rows) // 3
    return rows[:n], rows[n : 2 * n], rows[2 * n :]


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def run(frame, folder):
    frame.writeStream.format("parquet").option("path", f"{folder.path}/out").option("checkpointLocation", f"{folder.path}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def spikes_by_hand(rows, minutes, lookback, z, least, fill_gaps, forget, until):
    counts = Counter(DAY + dt.timedelta(minutes=(t - DAY).total_seconds() // 60 // minutes * minutes) for t, *_ in rows)
    step, past, last, found = dt.timedelta(minutes=minutes), [], None, []
    for start in sorted(counts):
        if start + step > until:
            break
        if last is not None and forget and start - last > forget:
            past = []
        elif last is not None and fill_gaps:
            past += [0] * ((start - last) // step - 1)
        past = past[-lookback:]
        n = len(past)
        if n >= least:
            mean = sum(past) / n
            threshold = mean + z * math.sqrt(n * sum(c * c for c in past) - sum(past) ** 2) / n
            if counts[start] > threshold:
                found.append((start, counts[start], round(mean, 6), round(threshold, 6)))
        past.append(counts[start])
        last = start
    return found


@pytest.mark.parametrize("fill_gaps", [False, True])
def test_live_spikes_equal_the_batch_over_restarts(spark, folder, traffic, fill_gaps):
    for part in thirds(traffic):
        folder.add(part)
        run(live_spikes(folder.stream(), "5 minutes", 12, 2.0, fill_gaps=fill_gaps), folder)
    closed = max(t for t, *_ in traffic) - dt.timedelta(minutes=7)
    expected = spikes(spark.createDataFrame(traffic, SCHEMA), "5 minutes", 12, 2.0, fill_gaps=fill_gaps).filter(F.col("window_start") <= F.lit(closed))
    got = plain(spark.read.parquet(f"{folder.path}/out"))
    assert got == plain(expected) and any(r[0] == DAY + dt.timedelta(hours=5) for r in got)


def test_live_spikes_by_key_forget_silent_series(spark, folder, traffic):
    """Each page is a series; one that was silent for longer than asked for starts anew."""
    quiet = [r for r in traffic if not (r[2] == "c" and 100 <= (r[0] - DAY).seconds // 60 < 400)]
    for part in thirds(quiet):
        folder.add(part)
        run(live_spikes(folder.stream(), "5 minutes", 10, 1.5, min_history=4, by=["url"], forget="60 minutes"), folder)
    got = spark.read.parquet(f"{folder.path}/out")
    until = max(t for t, *_ in quiet) - dt.timedelta(minutes=2)
    for url in "abc":
        expected = spikes_by_hand([r for r in quiet if r[2] == url], 5, 10, 1.5, 4, False, dt.timedelta(minutes=60), until)
        assert plain(got.filter(F.col("url") == url).drop("url")) == sorted(expected, key=repr)


def test_top_clients_of_stored_sketches(spark, folder, traffic):
    for part in thirds(traffic):
        folder.add(part)
        to_summaries(folder.stream(), f"{folder.path}/s", f"{folder.path}/checkpoint", available_now=True, width="30 minutes", top=["ip"]).awaitTermination()
    events, stored = spark.createDataFrame(traffic, SCHEMA), read_summaries(spark, f"{folder.path}/s")
    assert plain(stored_top_k(stored, events, "ip", 8)) == plain(top_k(events, "ip", 8))
    since, until = DAY + dt.timedelta(hours=2), DAY + dt.timedelta(hours=6)
    some = events.filter(F.col("timestamp").between(F.lit(since), F.lit(until - dt.timedelta(microseconds=1))))
    part = read_summaries(spark, f"{folder.path}/s", since, until)
    assert plain(stored_top_k(part, some, "ip", 5)) == plain(top_k(some, "ip", 5))
    assert merged(part).first()["request_count"] == some.count()
    hours = {r.window_start: r.request_count for r in merged(stored, "1 hour").collect()}
    assert hours == Counter(t.replace(minute=0, second=0, microsecond=0) for t, *_ in traffic)


def test_flat_counts_are_counted_in_full(spark, folder):
    """Many clients of few requests each: the sketch proves nothing, the answer is right all the same."""
    rows = [(DAY + dt.timedelta(seconds=i), f"c{i % 700:03d}", "a", 1) for i in range(2100)] + [(DAY, "c699", "a", 1)]
    folder.add(rows)
    to_summaries(folder.stream(), f"{folder.path}/s", f"{folder.path}/checkpoint", available_now=True, top=["ip"], tracked=12).awaitTermination()
    assert top_error(len(rows), 12) > 4
    events = spark.createDataFrame(rows, SCHEMA)
    got = stored_top_k(read_summaries(spark, f"{folder.path}/s"), events, "ip", 10, tracked=12)
    assert plain(got) == plain(top_k(events, "ip", 10)) and got.orderBy("rank").first().ip == "c699"


def test_percentiles_of_stored_sketches(spark, folder, traffic):
    for part in thirds([r if i % 9 else (*r[:3], None) for i, r in enumerate(traffic)]):
        folder.add(part)
        to_summaries(folder.stream(), f"{folder.path}/s", f"{folder.path}/checkpoint", available_now=True, width="10 minutes", by=["url"], values=["content_size"], accuracy=100).awaitTermination()
    stored = read_summaries(spark, f"{folder.path}/s")
    for r in stored_percentiles(stored, "content_size", (0.1, 0.5, 0.99), ["url"]).collect():
        sizes = [x[3] for i, x in enumerate(traffic) if i % 9 and x[2] == r.url]
        assert r.value_count == len(sizes)
        for p, name in ((0.1, "p10"), (0.5, "p50"), (0.99, "p99")):
            assert sum(s < r[name] for s in sizes) / len(sizes) <= p + rank_error(100)
            assert sum(s <= r[name] for s in sizes) / len(sizes) >= p - rank_error(100)


def test_summaries_of_another_checkpoint_are_refused(spark, folder, traffic):
    folder.add(traffic[:50])
    start = lambda checkpoint: to_summaries(folder.stream(), f"{folder.path}/s", f"{folder.path}/{checkpoint}", available_now=True)
    start("one").awaitTermination()
    start("one").awaitTermination()
    with pytest.raises(ValueError, match="another query"):
        start("two")
    assert read_summaries(spark, f"{folder.path}/s").agg(F.sum("request_count")).first()[0] == 50


def by_hand(minutes, level):
    cut = {"minute": lambda t: t, "hour": lambda t: t.replace(minute=0), "day": lambda t: t.replace(hour=0, minute=0)}[level]
    out = Counter()
    for (t, key), n in minutes.items():
        out[cut(t), key] += n
    return [(t, k, n) for (t, k), n in out.items()]


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_late_updates_and_replays_renew_their_ancestors_alone(spark, tmp_path):
    root, rng = f"{tmp_path}/r", random.Random(5)
    minutes = {(DAY + dt.timedelta(days=d, hours=rng.randrange(24), minutes=rng.randrange(60)), k): rng.randrange(1, 9) for d in (0, 1, 40) for k in ("a", None) for _ in range(40)}
    put = lambda rows: roll_up(spark.createDataFrame([(t, k, n) for (t, k), n in rows.items()], "window_start timestamp, key string, request_count bigint"), root, ["key"])
    put(minutes)
    equal = lambda: all(sorted((tuple(r) for r in read_rollup(spark, root, level).collect()), key=repr) == sorted(by_hand(minutes, level), key=repr) for level in ("minute", "hour", "day"))
    assert equal()
    before = files(root)
    late = {next(k for k in minutes if k[0].day == 2): 100, (DAY + dt.timedelta(days=1, hours=3, minutes=7), "new"): 5}
    minutes |= late
    put(late)
    assert equal()
    kept = set(before.items()) & set(files(root).items())
    hours = {t.strftime("%Y-%m-%d-%H") for t, _ in late}
    untouched = {f for f in before if not any(f"minute/part={h}" in f for h in hours) and "hour/part=2024-01-02" not in f and "day/part=2024-01-01-00" not in f}
    assert {f for f, _ in kept} == untouched and any("2024-02" in f for f in untouched)
    put(late)  # the same batch again
    assert equal()
    put({})
    assert equal()


def test_rollups_of_a_stream(spark, folder, traffic):
    for part in thirds(traffic):
        folder.add(part)
        to_rollups(folder.stream(), f"{folder.path}/r", f"{folder.path}/checkpoint", keys=["url"], available_now=True).awaitTermination()
    minutes = Counter((t.replace(second=0, microsecond=0), u) for t, _, u, _ in traffic)
    for level in ("minute", "hour", "day"):
        assert plain(read_rollup(spark, f"{folder.path}/r", level)) == sorted(by_hand(minutes, level), key=repr)
    noon = DAY + dt.timedelta(hours=4)
    assert read_rollup(spark, f"{folder.path}/r", "hour", noon, noon + dt.timedelta(hours=1)).count() == 3
