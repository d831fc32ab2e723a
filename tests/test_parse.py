import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglathe import format_clf, parse_clf, reject_counts, rejects, with_message_key
from loglathe.functions.clf import CLF_PATTERN

CORPUS = [
    '199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/ HTTP/1.0" 200 6245',
    'unicomp6.unicomp.net - - [01/Jul/1995:00:00:06 -0400] "GET /x HTTP/1.0" 304 -',
    "junk",
    'pre fix 1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "GET /x" 404 12 "http://ref" "UA/1"',
    '1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "" 400 0',
    '1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "GET /a"b HTTP/1.0" 400 0',
    '1.2.3.4 - - [bad] "HELLO" 99999999999 abc',
    '1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "GET /x" 500 3000000000',
    '1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "  GET /lead HTTP/1.1" 200 1',
]
T1, T6 = datetime(1995, 7, 1, 4, 0, 1), datetime(1995, 7, 1, 4, 0, 6)
EXPECTED = [
    ("199.72.81.55", T1, "GET", "/history/", "HTTP/1.0", 200, 6245),
    ("unicomp6.unicomp.net", T6, "GET", "/x", "HTTP/1.0", 304, 0),
    ("1.2.3.4", T6, "GET", "/x", "", 404, 12),
    ("1.2.3.4", None, "HELLO", "", "", None, None),
    ("1.2.3.4", T6, "GET", "/x", "", 500, 3000000000),
    ("1.2.3.4", T6, "", "", "", 200, 1),
]
COLUMNS = ["ip", "timestamp", "method", "url", "protocol", "status_code", "content_size"]


def utc(df):
    """Instants as plain UTC datetimes, whatever the zone of this machine."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_corpus(lines):
    parsed = utc(parse_clf(lines(*CORPUS), on_bad_ts="null")).select(*COLUMNS)
    assert [tuple(row) for row in parsed.collect()] == EXPECTED


def test_schema_and_buckets(lines):
    row = parse_clf(lines(CORPUS[0])).first()
    assert list(row.asDict()) == [
        "ip", "timestamp", "method", "url", "protocol", "status_code", "content_size", "hour", "minute",
        "kafka_timestamp", "raw_log",
    ]
    assert (row["hour"], row["minute"]) == ("1995-07-01 04:00:00", "1995-07-01 04:00:00")
    assert row["kafka_timestamp"] is None and row["raw_log"] == CORPUS[0]


def test_bad_timestamp_modes(lines):
    assert parse_clf(lines(CORPUS[6])).count() == 0
    assert parse_clf(lines(CORPUS[6]), on_bad_ts="null").first()["timestamp"] is None
    assert parse_clf(lines(CORPUS[6]), on_bad_ts="now").first()["timestamp"].year >= 2024
    with pytest.raises(ValueError):
        parse_clf(lines(CORPUS[6]), on_bad_ts="guess")


def test_wall_clock_ignores_the_offset_but_needs_it(lines):
    no_offset = CORPUS[0].replace(" -0400", "")
    parsed = utc(parse_clf(lines(CORPUS[0], no_offset), keep_offset=False, on_bad_ts="null"))
    assert [row["timestamp"] for row in parsed.collect()] == [datetime(1995, 7, 1, 0, 0, 1), None]


def test_rejects_are_the_complement(spark, lines):
    df = lines(*CORPUS, None, "")
    bad = {(row["raw_log"], row["cause"]) for row in rejects(df).collect()}
    assert bad == {
        (CORPUS[2], "no_match"), (CORPUS[4], "no_match"), (CORPUS[5], "no_match"),
        (CORPUS[6], "bad_timestamp"), (None, "no_match"), ("", "no_match"),
    }
    assert parse_clf(df).count() + rejects(df).count() == df.count()
    counts = {row["cause"]: row["line_count"] for row in reject_counts(df).collect()}
    assert counts == {"no_match": 5, "bad_timestamp": 1}


def test_combined_format_and_identity(lines):
    head = '1.2.3.4 id bob [01/Jul/1995:00:00:06 -0400] "GET /x HTTP/1.0" 200 12'
    df = lines(head + ' "http://a/b" "X \\"quoted\\" (y; z) 1"', head + ' "-" "-"', head, head + ' "only one"')
    rows = parse_clf(df, combined=True, identity=True).collect()
    assert [(r["referrer"], r["agent"]) for r in rows] == [
        ("http://a/b", 'X \\"quoted\\" (y; z) 1'), (None, None), (None, None), ("only one", None)
    ]
    assert {(r["remote_log_name"], r["remote_user"]) for r in rows} == {("id", "bob")}


def test_regex_runs_once_per_line(lines):
    parsed = parse_clf(lines(*CORPUS)).filter("status_code >= 400").filter("url != '/'")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("gettimestamp") == 1


def test_long_junk_line(lines):
    text = "word " * 4000 + "[" * 50 + '"' * 51
    assert rejects(lines(text, "x" * 100_000)).count() == 2


WORDS = ["1.2.3.4", "host", "-", "a]b", 'q"', "[x", "200", "GET", "/a", "HTTP/1.0", "é", "$1", "\\", "404", "\u00a0"]
BLANKS = [" ", " ", " ", "  ", "\t", ""]


def random_line(rng):
    def word():
        return rng.choice(WORDS)

    def blank():
        return rng.choice(BLANKS)

    def quoted():
        return '"' + "".join(blank() + word() for _ in range(rng.randrange(5))) + blank() + '"'

    def bracketed():
        time = "01/Jul/1995:00:00:06 -0400"
        return "[" + rng.choice([time, time, " ".join(word() for _ in range(rng.randrange(3)))]) + "]"

    def wild():
        parts = [word, quoted, bracketed, blank]
        return "".join(rng.choice(parts)() + blank() for _ in range(rng.randrange(6)))

    fields = [word(), word(), word(), bracketed(), quoted(), str(rng.randrange(600)), word()]
    near = "".join(field + rng.choice(BLANKS) for field in fields)
    return rng.choice([wild, lambda: wild() + near + wild(), lambda: near, lambda: near + wild()])()


def test_equals_seven_separate_extractions(spark):
    rng = random.Random(0)
    texts = [random_line(rng) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw_log string")
    group = [F.regexp_extract("raw_log", CLF_PATTERN, i) for i in range(8)]
    request = group[5]
    plain = df.filter(group[1] != "").select(
        "n",
        group[1],
        group[2],
        group[3],
        F.regexp_extract(request, r"^(\S+)", 1),
        F.regexp_extract(request, r"^\S+\s+(\S+)", 1),
        F.regexp_extract(request, r"^\S+\s+\S+\s+(\S+)", 1),
        group[6].try_cast("int"),
        F.when(group[7] == "-", F.lit(0)).otherwise(group[7].try_cast("bigint")),
    )
    ours = parse_clf(df, on_bad_ts="null", identity=True, keep=["n"]).select(
        "n", "ip", "remote_log_name", "remote_user", "method", "url", "protocol", "status_code", "content_size"
    )
    expected = {row["n"]: tuple(row) for row in plain.collect()}
    assert {row["n"]: tuple(row) for row in ours.collect()} == expected
    assert 1000 < len(expected) < 5000


def test_round_trip(lines):
    first = parse_clf(lines(*CORPUS[:2], CORPUS[3], CORPUS[7]))
    again = parse_clf(format_clf(first))
    assert sorted(map(tuple, again.select(*COLUMNS).collect())) == sorted(map(tuple, first.select(*COLUMNS).collect()))


def test_format_carries_the_session_offset(spark, lines):
    df = parse_clf(lines(CORPUS[0]))
    assert "[01/Jul/1995:04:00:01 +0000]" in format_clf(df).first()["raw_log"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert "[01/Jul/1995:00:00:01 -0400]" in format_clf(parse_clf(lines(CORPUS[0]))).first()["raw_log"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_message_key(spark):
    rows = [(" 1.2.3.4 - x\n", ""), ("host.name - x", None), ("1.2.3.4 y", "mine"), ("x 1.2.3.4", "")]
    df = spark.createDataFrame(rows, "raw_log string, k string")
    assert [tuple(r) for r in with_message_key(df, key="k").collect()] == [
        ("1.2.3.4", "1.2.3.4 - x"), ("unknown", "host.name - x"), ("mine", "1.2.3.4 y"), ("unknown", "x 1.2.3.4")
    ]
    assert [r["key"] for r in with_message_key(df, host=True).collect()] == ["1.2.3.4", "host.name", "1.2.3.4", "x"]


def test_the_broken_field_is_named(spark, lines):
    """Every field damaged in turn, with blanks and lines that are no log lines at all."""
    from loglathe import reject_fields

    start = '1.2.3.4 - - [01/Jul/1995:00:00:06 -0400] "GET /x HTTP/1.0" '
    expected = {
        "": ("client", 1), "1.2.3.4": ("log_name", 8), "1.2.3.4  -": ("user", 11), "1.2.3.4 - -": ("time", 12), "1.2.3.4 - - 01/Jul": ("time", 12),
        "1.2.3.4 - - []": ("time", 12), start[:40] + " GET": ("request", 41), start[:40] + ' "" 400 0': ("request", 41), start + "abc 12": ("status", len(start)),
        start + "20x 12": ("status", len(start)), start + "200": ("size", len(start) + 3 + 1), start + "200 ": ("size", len(start) + 4),
        "1.2.3.4 - - [never] \"GET /\" 200 1": ("time", 14), "1.2.3.4 - - [30/Feb/1995:00:00:06 -0400] \"GET /\" 200 1": ("time", 14),
    }
    frame = lines(*expected, start + "200 1")
    got = {r.raw_log: (r.field, r.position) for r in reject_fields(frame).collect()}
    assert got == expected
