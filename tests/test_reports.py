import ipaddress
import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from loglathe import (
    agent_stats,
    check_ranges,
    error_trend,
    locate,
    locate_networks,
    product_stats,
    referrer_stats,
    retain,
    search,
    search_ranked,
    search_text,
    spikes,
    status_distribution,
    table_stats,
    top_k,
    upsert,
    value_percentiles,
)
from loglathe.functions import agent_details, ip_key
from loglathe.operators import reports


def test_status_distribution_counts_once(events):
    df = events(*[("a", "2024-01-01", "/", s) for s in [200, 200, 404, None]])
    rows = {r["status_code"]: (r["request_count"], r["share"]) for r in status_distribution(df).collect()}
    assert rows == {200: (2, 0.5), 404: (1, 0.25), None: (1, 0.25)}
    assert "ReusedExchange" in plan_of(status_distribution(df))


def test_top_k_ties_and_bounds(events):
    df = events(*[(ip, "2024-01-01", "/", 200) for ip in "ccbbaad"])
    assert [tuple(r) for r in top_k(df, "ip", 2).orderBy("rank").collect()] == [(1, "a", 2), (2, "b", 2)]
    assert "TakeOrderedAndProject" in plan_of(top_k(df, "ip", 2))


@pytest.mark.parametrize("threshold", ["1000", "2"])
def test_top_k_per_window(spark, events, threshold):
    rng = random.Random(1)
    # One window holds most rows, one key a third of them.
    rows = [
        ("hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}", f"2024-01-01 0{rng.choice('00000123')}:10:00", "/", 200)
        for _ in range(600)
    ]
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        result = [tuple(r) for r in top_k(events(*rows), "ip", 5, width="1 hour").select(
            F.hour("window_start"), "rank", "ip", "request_count").collect()]
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
    expected = []
    for hour in range(4):
        counts = Counter(ip for ip, ts, _, _ in rows if int(ts[11:13]) == hour)
        ranked = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:5]
        expected += [(hour, i + 1, ip, n) for i, (ip, n) in enumerate(ranked)]
    assert sorted(result) == sorted(expected)


@pytest.mark.parametrize("block", [4096, 30])
def test_spikes_equal_one_ordered_pass(events, monkeypatch, block):
    monkeypatch.setattr(reports, "SPIKE_BLOCK", block)
    rng = random.Random(2)
    start, counts = datetime(2024, 1, 1), {}
    for hour in range(300):
        if rng.random() < 0.7:  # hours without traffic leave no row
            counts[start + timedelta(hours=hour)] = rng.randrange(1, 6) + (25 if rng.random() < 0.05 else 0)
    rows = [("a", str(hour), "/", 200) for hour, n in counts.items() for _ in range(n)]
    result = {
        (r["window_start"], r["request_count"])
        for r in spikes(events(*rows), lookback=24).withColumn(
            "window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    }
    expected, hours = set(), sorted(counts)
    for i in range(24, len(hours)):
        window = np.array([counts[h] for h in hours[i - 24:i]], dtype=float)
        if counts[hours[i]] > window.mean() + 3 * window.std():
            expected.add((hours[i], counts[hours[i]]))
    assert result == expected and expected


def test_spikes_with_gaps_filled(events):
    """After an outage the quiet hours count: the same traffic as before it is no spike, or is one."""
    def hour(h, n):
        return [("a", f"2024-01-{1 + h // 24:02d} {h % 24:02d}:{i % 60:02d}:00", "/", 200) for i in range(n)]

    hours = {**{h: 10 + h % 3 for h in range(24)}, 60: 12}
    df = events(*[row for h, n in hours.items() for row in hour(h, n)])
    assert spikes(df, lookback=24, z=3.0).count() == 0
    found = spikes(df, lookback=24, z=3.0, fill_gaps=True).collect()
    assert [(r["window_start"].hour, r["request_count"], r["baseline"]) for r in found] == [(12, 12, 0.0)]
    assert spikes(df.limit(0), fill_gaps=True).count() == 0


def test_error_trend_forgets_old_windows_as_a_stream(spark, tmp_path):
    stream = spark.readStream.schema("timestamp timestamp, status_code int").json(str(tmp_path))
    assert "EventTimeWatermark" in error_trend(stream)._jdf.queryExecution().analyzed().toString()


def test_percentiles_equal_numpy(spark):
    rng = random.Random(3)
    groups = {
        "hot": [7.25] * 900 + [rng.gauss(0, 1) for _ in range(100)],  # copies of one value
        "wide": [rng.uniform(-1e9, 1e9) for _ in range(777)],
        "tiny": [1.5],
        None: [0.0, -0.0, 2.0, 3.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    ps = [0.0, 0.25, 0.5, 0.95, 0.999, 1.0]
    result = {r["g"]: tuple(r)[1:] for r in value_percentiles(df, "x", ["g"], ps).collect()}
    assert result.keys() == groups.keys()
    for g, values in groups.items():
        assert result[g] == pytest.approx(np.quantile(values, ps), rel=1e-12, abs=1e-12)
    overall = value_percentiles(df, "x", (), ps)
    assert overall.columns == ["p0", "p25", "p50", "p95", "p99_9", "p100"]
    everything = [v for values in groups.values() for v in values]
    assert tuple(overall.first()) == pytest.approx(np.quantile(everything, ps), rel=1e-12, abs=1e-12)


def test_percentiles_combine_copies_before_any_join(spark):
    """A value on a third of the rows is one row below every join, also without broadcasts."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1)).alias("x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = value_percentiles(df, "x", (), [0.5, 0.9])
        values = sorted(r["x"] for r in df.collect())
        assert tuple(found.first()) == pytest.approx(np.quantile(values, [0.5, 0.9]))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # What is joined is the stored table of distinct values, not the rows.
    assert "CollectLimit" not in plan and "Range (0, 3000" not in plan and "Join" in plan


def test_percentiles_over_many_partitions(spark):
    rng = random.Random(9)
    rows = [(g, float(rng.randrange(500))) for g in "abc" for _ in range(700)]
    settings = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = {r["g"]: tuple(r)[1:] for r in value_percentiles(spark.createDataFrame(rows, "g string, x double"), "x", ["g"], [0.1, 0.5, 0.99]).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for g in "abc":
        assert result[g] == pytest.approx(np.quantile([x for h, x in rows if h == g], [0.1, 0.5, 0.99]))


def test_percentile_sketch(spark):
    df = spark.range(1, 1001).withColumnRenamed("id", "x")
    assert tuple(value_percentiles(df, "x", ps=[0.5, 0.99], accuracy=10000).first()) == (500.0, 990.0)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, x double")
    assert value_percentiles(df, "x", ["g"]).count() == 0
    assert value_percentiles(df, "x").count() == 0


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def dotted(n):
    return ".".join(str(n >> shift & 255) for shift in (24, 16, 8, 0))


RANGES = [
    ("10.0.0.5", "10.0.0.5", "one address"),
    ("10.0.0.250", "10.0.3.17", "over /24 borders"),
    ("10.0.255.3", "10.4.0.0", "whole /16 blocks inside"),
    ("10.5.0.0", "10.5.255.255", "one whole /16"),
    ("10.6.0.0", "10.6.0.255", "one whole /24"),
    ("255.255.255.0", "255.255.255.255", "the end"),
]


@pytest.fixture
def broadcast_below(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda limit: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", ["64MB", "-1"])
def test_locate_equals_brute_force(spark, broadcast_below, limit):
    broadcast_below(limit)
    edges = [number(end) + step for first, last, _ in RANGES for end in (first, last) for step in (-1, 0, 1)]
    rng = random.Random(4)
    addresses = [n for n in edges if n < 2**32] + [number("10.0.0.0") + rng.randrange(8 << 16) for _ in range(300)]
    hosts = ["host.example", "1.2.3", "1.2.3.999", "", None, "10.0.0.5 ", "1.2.3.4.5"]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate([*map(dotted, addresses), *hosts])], "n int, ip string")
    ranges = spark.createDataFrame(RANGES, "start string, end string, place string")
    result = {r["n"]: r["place"] for r in locate(df, ranges).collect()}

    def place(n):
        return next((p for first, last, p in RANGES if number(first) <= n <= number(last)), None)

    expected = [place(n) for n in addresses] + [None] * len(hosts)
    assert result == dict(enumerate(expected))


def test_locate_splits_a_hot_block(spark):
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "10.0.0.7").otherwise(
            F.concat(F.lit("10.0."), F.col("id") % 200, F.lit(".1"))).alias("ip"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    ranges = spark.createDataFrame([("10.0.0.0", "10.0.255.254", "all")], "start string, end string, place string")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        located = locate(df, ranges)
        plan = plan_of(located)
        assert located.filter("place = 'all'").count() == 200_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_host_names_do_not_meet_in_one_task(spark, broadcast_below):
    """Nine in ten clients are host names: a merge join spreads them over its partitions."""
    broadcast_below("-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "10.0.0.7").otherwise("gateway.example").alias("ip")
    )
    ranges = spark.createDataFrame([("10.0.0.0", "10.0.0.254", "here")], "start string, end string, place string")
    located = locate(df, ranges)
    assert located.filter("place = 'here'").count() == 2_000 and located.count() == 20_000
    assert "SortMergeJoin" in plan_of(located)
    sizes = [r["count"] for r in located.filter("place IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("extra", [
    ("10.0.3.17", "10.0.3.20", "last address again"),
    ("10.2.0.9", "10.2.0.9", "inside a whole /16"),
    ("10.4.0.0", "10.5.0.0", "into the next"),
    ("10.5.0.0", "10.5.255.255", "twice"),
    ("9.0.0.0", "11.0.0.0", "around all"),
    ("11.0.0.9", "11.0.0.1", "backwards"),
    ("11.0.0.9", "nowhere", "no address"),
])
def test_ranges_are_checked(spark, extra):
    check_ranges(spark.createDataFrame(RANGES, "start string, end string, place string"))
    with pytest.raises(ValueError):
        check_ranges(spark.createDataFrame([*RANGES, extra], "start string, end string, place string"))


def test_upsert(spark):
    schema = "k string, v int, processed_at int"
    current = spark.createDataFrame([("a", 1, 9), ("b", 2, 9), (None, 3, 9)], schema)
    updates = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("c", 12, 1), (None, 13, 1)], schema)
    merged = upsert(current, updates, ["k"])
    assert {tuple(r) for r in merged.collect()} == {("a", 11, 2), ("b", 2, 9), ("c", 12, 1), (None, 13, 1)}
    assert plan_of(merged).count("WindowGroupLimit") >= 2  # before and after the shuffle


def test_search(events):
    df = events(*[("a", f"2024-01-0{d}", f"/p{d}", 404) for d in range(1, 6)])
    found = search(df, F.col("url") != "/p5", [F.desc("timestamp")], size=2)
    assert [r["url"] for r in found.collect()] == ["/p4", "/p3"]
    assert search(df, "status_code = 200").count() == 0


def test_search_text(events):
    df = events(*[("a", "2024-01-01", u, 200) for u in ["/News/Index.html", "/newsletter", "/index/old-news", None]])

    def urls(*args, **kwargs):
        return [r["url"] for r in search_text(df, ["url"], *args, **kwargs).collect()]

    assert urls("NEWS") == ["/News/Index.html", "/index/old-news"]
    assert urls(["news", "html"]) == ["/News/Index.html"]
    assert urls("html newsletter", match="any") == ["/News/Index.html", "/newsletter"]
    with pytest.raises(ValueError):
        urls("--")


def test_search_text_in_other_scripts(events):
    df = events(*[("a", "2024-01-01", u, 200) for u in ["/Новости/главная", "/café/MENÜ", "/cafe/menu", "/новостная"]])

    def urls(*args, **kwargs):
        return [r["url"] for r in search_text(df, ["url"], *args, **kwargs).collect()]

    assert urls("новости") == ["/Новости/главная"]
    assert urls("café") == ["/café/MENÜ"] and urls("caf") == []
    assert urls("menü menu", match="any") == ["/café/MENÜ", "/cafe/menu"]


def test_agents_and_referrers(spark):
    rows = [
        ("Mozilla/5.0 (Windows NT 10.0) Chrome/120 Safari/537.36 Edg/120", "https://A.example:80/x"),
        ("Mozilla/5.0 (iPad; CPU OS 17) Version/17 Safari/604.1", "https://a.example/y"),
        ("curl/8.1", "android-app://com.example/"),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "agent string, referrer string")
    assert {tuple(r) for r in agent_stats(df).collect()} == {
        ("Edge", "Desktop", 1), ("Safari", "Tablet", 1), ("Command line", "Other", 1), ("None", "None", 1)
    }
    assert {tuple(r) for r in referrer_stats(df).collect()} == {("a.example", 2), ("com.example", 1), (None, 1)}


def test_retain_and_stats(events):
    df = events(*[("a", f"2024-01-0{d} 12:00:00", "/", 200) for d in range(1, 6)])
    kept = retain(df, "timestamp", 2, as_of="2024-01-05 12:00:00")
    row = table_stats(kept.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), "timestamp").first()
    assert tuple(row) == (3, datetime(2024, 1, 3, 12), datetime(2024, 1, 5, 12))


def key_of(text):
    """The 128 bits as the standard library reads them; None where it refuses."""
    try:
        found = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(found) + ((0xFFFF << 32) if found.version == 4 else 0)


def test_address_keys_equal_the_standard_library(spark):
    rng = random.Random(9)
    texts = ["::", "::1", "1::", "1::8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "2001:DB8::aB",
             "::ffff:10.0.0.7", "1:2:3:4:5:6:10.0.0.7", "64:ff9b::192.0.2.33", "FFFF:ffff:ffff:ffff:ffff:ffff:ffff:ffff",
             "", ":", ":::", "1:::2", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4::5:6:7:8", "12345::", "g::1",
             ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", ":1::2", "1::2:", "::10.0.0.256", "::10.0.0", "1.2.3.4::", "10.0.0.7:80",
             "[::1]", "::1/64", " ::1", "::1 ", "10.0.0.7", "host.example", "fe80", "::1.2.3.4:5"]
    for _ in range(400):
        n = rng.getrandbits(128) & rng.choice([2**128 - 1, 0xFFFF << 64 | 0xFFFF, rng.getrandbits(128)])
        address = ipaddress.IPv6Address(n)
        texts.append(rng.choice([address.compressed, address.exploded, address.compressed.upper()]))
        cut = list(texts[-1])
        cut[rng.randrange(len(cut))] = rng.choice(":0f.g")
        texts.append("".join(cut))
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "n int, ip string").select("n", ip_key(F.col("ip")).alias("key")).collect()
    result = {r["n"]: None if r["key"] is None else (r["key"]["high"] % 2**64) << 64 | r["key"]["low"] % 2**64 for r in rows}
    # Octets with leading zeros are IPv4 here, as in the table of ranges; the library refuses them.
    assert [(t, result[n]) for n, t in enumerate(texts)] == [(t, key_of(t)) for t in texts] and result[len(texts)] is None


NETWORKS = [
    ("0.0.0.0/0", "all of IPv4"), ("10.0.0.0/8", "ten"), ("10.1.0.0/16", "ten one"), ("10.1.2.3", "one address"), ("10.1.2.0/31", "two"),
    ("2000::/3", "global"), ("2001:db8::/32", "documentation"), ("2001:db8:0:8000::/49", "half"), ("2001:db8::/64", "low"),
    ("2001:db8:0:0:8000::/65", "upper low"), ("2001:db8::1/128", "v6 address"), ("::1", "loop"),
]


@pytest.mark.parametrize("limit", ["64MB", "-1"])
def test_networks_equal_brute_force(spark, broadcast_below, limit):
    broadcast_below(limit)
    parsed = [(ipaddress.ip_network(n), place) for n, place in NETWORKS]
    rng = random.Random(5)
    addresses = []
    for net, _ in parsed:
        ends = [int(net.network_address), int(net.broadcast_address)]
        for n in [*(e + step for e in ends for step in (-1, 0, 1)), *(rng.randint(*ends) for _ in range(20))]:
            if 0 <= n < 2**net.max_prefixlen:
                addresses.append(str(type(net.network_address)(n)))
    addresses += [f"::ffff:{a}" for a in addresses if ":" not in a][:50] + ["10.1.2.3"] * 300
    hosts = ["host.example", "", None, "1::2::3"]
    df = spark.createDataFrame(list(enumerate([*addresses, *hosts])), "n int, ip string")
    networks = spark.createDataFrame(NETWORKS, "network string, place string")
    result = {r["n"]: r["place"] for r in locate_networks(df, networks).collect()}

    def place(text):
        address = ipaddress.ip_address(text)
        address = getattr(address, "ipv4_mapped", None) or address
        return max(((net.prefixlen, name) for net, name in parsed if net.version == address.version and address in net), default=(0, None))[1]

    assert result == dict(enumerate([*map(place, addresses), *[None] * len(hosts)]))


@pytest.mark.parametrize("wrong", ["10.0.0.1/8", "10.0.0.0/33", "2001:db8::/129", "host/8", "10.0.0.0/", "10.0.0.0/8/9", "::/x", "10.0.0.0/08"])
def test_wrong_networks_are_refused(spark, wrong):
    networks = spark.createDataFrame([("10.0.0.0/8", "a"), (wrong, "b")], "network string, place string")
    df = spark.createDataFrame([("10.0.0.1",)], "ip string")
    with pytest.raises(ValueError, match="malformed network|network given twice"):
        locate_networks(df, networks)


def test_networks_of_an_empty_table_and_taken_columns(spark):
    df = spark.createDataFrame([("10.0.0.1", "x", 1), ("10.0.0.1", "x", 1)], "ip string, `a.b` string, bits int")
    none = spark.createDataFrame([], "network string, place string")
    assert [tuple(r) for r in locate_networks(df, none).collect()] == [("10.0.0.1", "x", 1, None)] * 2
    one = spark.createDataFrame([("10.0.0.0/8", "ten")], "network string, place string")
    assert [tuple(r) for r in locate_networks(df, one).collect()] == [("10.0.0.1", "x", 1, "ten")] * 2
    assert locate_networks(df.limit(0), one).count() == 0


@pytest.mark.parametrize("terms", [["alpha"], ["alpha", "beta gamma"], ["alpha alpha"], ["Éa", "nothing", "beta"]])
def test_ranked_search_equals_brute_force(spark, terms):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "Beta", "gamma,", "éa", "x-y", "alpha/alpha"]) for _ in range(rng.randrange(12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "n int, text string")
    split = [[w for w in re.split(r"[\W_]+", (t or "").lower()) if w] for t in [*texts, None, ""]]
    mean = sum(map(len, split)) / len(split)
    scores = [0.0] * len(split)
    for term in terms:
        words = term.lower().split()
        counts = [sum(doc[i : i + len(words)] == words for i in range(len(doc))) for doc in split]
        n = sum(c > 0 for c in counts)
        for i, f in enumerate(counts):
            scores[i] += math.log(1 + (len(split) - n + 0.5) / (n + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(split[i]) / mean))
    expected = sorted(((-round(s, 9), i) for i, s in enumerate(scores) if s > 0))[:50]
    found = search_ranked(df, ["text"], terms, 1000).collect()
    result = sorted((-round(r["score"], 9), r["n"]) for r in found)[:50]
    assert result == expected and len(found) == sum(s > 0 for s in scores)
    best = search_ranked(df, ["text"], terms, 5, ["n"])
    assert [r["n"] for r in best.collect()] == [r["n"] for r in sorted(found, key=lambda r: (-r["score"], r["n"]))[:5]]
    assert "TakeOrderedAndProject" in plan_of(best)


def test_ranked_search_without_rows_or_terms(spark):
    df = spark.createDataFrame([], "text string")
    assert search_ranked(df, ["text"], "a").count() == 0
    for wrong in ("", [" ", "-"]):
        with pytest.raises(ValueError, match="no search term"):
            search_ranked(df, ["text"], wrong)
    with pytest.raises(ValueError, match="taken"):
        search_ranked(df.selectExpr("text", "1 AS score"), ["text"], "a")


MOZILLA = "Mozilla/5.0 "
WEBKIT = "AppleWebKit/537.36 (KHTML, like Gecko) "
DETAILS = [
    (MOZILLA + "(Windows NT 10.0; Win64; x64) " + WEBKIT + "Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91", ("Edg", "120.0.2210.91", "Windows", "10.0", False)),
    (MOZILLA + "(Linux; Android 13; SM-S901B) " + WEBKIT + "SamsungBrowser/23.0 Chrome/115.0.0.0 Mobile Safari/537.36", ("SamsungBrowser", "23.0", "Android", "13", False)),
    (MOZILLA + "(Linux; Android 14; Pixel 8) " + WEBKIT + "Chrome/120.0.0.0 Mobile Safari/537.36", ("Chrome", "120.0.0.0", "Android", "14", False)),
    (MOZILLA + "(Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15", ("Safari", "17.1", "macOS", "10.15.7", False)),
    (MOZILLA + "(iPad; CPU OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/120.0.6099.50 Mobile/15E148 Safari/604.1", ("CriOS", "120.0.6099.50", "iOS", "16.6", False)),
    (MOZILLA + "(X11; CrOS x86_64 14541.0.0) " + WEBKIT + "Chrome/119.0.0.0 Safari/537.36", ("Chrome", "119.0.0.0", "ChromeOS", "14541.0.0", False)),
    (MOZILLA + "(X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0", ("Firefox", "121.0", "Linux", None, False)),
    (MOZILLA + "(compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)", ("MSIE", "9.0", "Windows", "6.1", False)),
    (MOZILLA + "(Windows NT 10.0; WOW64; Trident/7.0; rv:11.0) like Gecko", ("MSIE", "11.0", "Windows", "10.0", False)),
    (MOZILLA + "(compatible; Googlebot/2.1; +http://www.google.com/bot.html)", ("Googlebot", "2.1", None, None, True)),
    (MOZILLA + WEBKIT[:-2] + "; compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm) Chrome/116.0 Safari/537.36", ("bingbot", "2.0", None, None, True)),
    (MOZILLA + "(compatible; Yahoo! Slurp; http://help.yahoo.com/help/us/ysearch/slurp)", ("Yahoo! Slurp", None, None, None, True)),
    ("Opera/9.80 (Windows NT 6.1) Presto/2.12.388 Version/12.18", ("Opera", "12.18", "Windows", "6.1", False)),
    ("curl/8.4.0", ("curl", "8.4.0", None, None, False)),
    ("python-requests/2.31.0", ("python-requests", "2.31.0", None, None, False)),
    ("Wget", ("Wget", None, None, None, False)),
    ("((((", (None, None, None, None, False)),
    ("", (None, None, None, None, False)),
]


def test_agent_details(spark):
    df = spark.createDataFrame([(n, a) for n, (a, _) in enumerate(DETAILS)] + [(-1, None)], "n int, agent string")
    got = {r["n"]: r["d"] for r in df.select("n", agent_details(F.col("agent")).alias("d")).collect()}
    assert [(a, tuple(got[n])) for n, (a, _) in enumerate(DETAILS)] == DETAILS and got[-1] is None
    twice = product_stats(df.union(df))
    assert sum(r["request_count"] for r in twice.collect()) == 2 * len(DETAILS) + 2
    assert {tuple(r) for r in twice.filter("product = 'MSIE'").collect()} == {
        ("MSIE", "9.0", "Windows", "6.1", False, 2), ("MSIE", "11.0", "Windows", "10.0", False, 2)}
