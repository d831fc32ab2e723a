"""Access-log lines derived from the ``events`` table.

Some lines are damaged on purpose: every 97th is no log line at all, every 101st
has an unreadable time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clf import CLF_WALL_CLOCK_FORMAT
from ..session import spread, use_utc

AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/17.2 Mobile/15E148 Safari/604.1",
    "ExampleBot/2.1 (+https://bot.example/about)",
    "-",
]
OFFSETS = ["+0000", "-0400", "+0530"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with ``ts`` as an instant: a watermark needs TIMESTAMP, not NTZ."""
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _pick(texts: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(text) for text in texts]), (index % len(texts) + 1).cast("int"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of a request, one row per event."""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    failed = F.when(event % 3 == 0, 500).when(event % 3 == 1, 404).otherwise(403)
    # Writing and parsing a line costs more than moving an event.
    source = spread(events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value"))
    return source.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "user_id",
        F.concat(F.lit("10.0."), F.floor(user / 256), F.lit("."), user % 256).alias("ip"),
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/"), kind, F.lit("/"), event % 20).alias("url"),
        F.lit("HTTP/1.1").alias("protocol"),
        F.when(kind == "error", failed)
        .when((kind == "click") & (event % 10 == 0), 304)
        .otherwise(200)
        .alias("status_code"),
        F.when(event % 50 != 0, F.floor(F.col("value") * 100).cast("bigint")).alias("content_size"),
    )


def raw_lines(spark: SparkSession, sf_dir: str, combined: bool = False, offsets: bool = False) -> DataFrame:
    """``event_id``, ``timestamp`` and ``raw_log``, one row per event.

    ``combined`` appends referrer and agent, ``offsets`` varies the UTC offset.
    """
    event, user = F.col("event_id"), F.col("user_id")
    zone = _pick(OFFSETS, user) if offsets else F.lit(OFFSETS[0])
    time = F.when(event % 101 == 0, "bad").otherwise(
        F.concat(F.date_format("timestamp", CLF_WALL_CLOCK_FORMAT), F.lit(" "), zone)
    )
    parts = [
        "ip", F.lit(" - - ["), time, F.lit('] "'), "method", F.lit(" "), "url", F.lit(" "), "protocol", F.lit('" '),
        "status_code", F.lit(" "), F.coalesce(F.col("content_size").cast("string"), F.lit("-")),
    ]
    if combined:
        site = F.concat(F.lit("https://Site"), user % 7, F.lit(".example/page/"), event % 10)
        referrer = F.when(user % 4 == 0, "-").otherwise(site)
        parts += [F.lit(' "'), referrer, F.lit('" "'), _pick(AGENTS, user), F.lit('"')]
    line = F.when(event % 97 == 0, F.concat(F.lit("corrupt line "), event)).otherwise(F.concat(*parts))
    return requests(spark, sf_dir).select("event_id", "timestamp", line.alias("raw_log"))


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a topic would deliver them: binary value and arrival time."""
    lines = raw_lines(spark, sf_dir)
    return lines.select(F.encode("raw_log", "UTF-8").alias("value"), "timestamp")


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six client addresses per nation."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    first = F.lit(10 * 256**3).cast("bigint") + F.col("n_nationkey") * 6
    return nation.select(first.alias("start"), (first + 5).alias("end"), F.col("n_name").alias("place"))


def mixed_clients(events: DataFrame) -> DataFrame:
    """Events with ``client``: IPv6 for odd pages, the mapped form for every tenth, else IPv4."""
    user = F.split_part("ip", F.lit("."), F.lit(3)).try_cast("int") * 256 + F.split_part("ip", F.lit("."), F.lit(4)).try_cast("int")
    page = F.substring_index("url", "/", -1).try_cast("int")
    v6 = F.concat(F.lit("2001:DB8:"), F.hex(user % 25), F.lit("::"), F.hex(user))
    client = F.when(page % 2 == 1, v6).when(page % 10 == 0, F.concat(F.lit("::ffff:"), "ip")).otherwise(F.col("ip"))
    return events.withColumn("client", client)


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks of both families inside each other: all, then nations, then the first addresses of regions."""
    nation, region = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("nation", "region"))
    k = F.col("n_nationkey")
    outer = spark.createDataFrame([("10.0.0.0/8", "private"), ("2001:db8::/32", "documentation")], "network string, place string")
    v4 = nation.select(F.concat(F.lit("10.0.0."), k * 8, F.lit("/29")).alias("network"), F.col("n_name").alias("place"))
    v6 = nation.filter(k % 2 == 0).select(F.concat(F.lit("2001:db8:"), F.hex(k), F.lit("::/48")), "n_name")
    first = region.select(F.concat(F.lit("2001:db8:"), F.hex(F.col("r_regionkey") * 2), F.lit("::/124")), "r_name")
    return outer.union(v4).union(v6).union(first)
