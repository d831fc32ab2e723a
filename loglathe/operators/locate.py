"""Client location from a table of IPv4 ranges, or of networks of both families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.network import ip_key, ipv4_to_long, prefix_mask
from ..session import materialise

#: What an address of either family is written with; all else is a host name.
ADDRESS_TEXT = r"^[0-9A-Fa-f:.]+$"


def _bounds(ranges: DataFrame) -> DataFrame:
    """Ranges as (first, last, place) with numeric, inclusive ends."""

    def number(name: str) -> Column:
        column = F.col(name)
        return ipv4_to_long(column) if isinstance(ranges.schema[name].dataType, StringType) else column.cast("bigint")

    return ranges.select(number("start").alias("first"), number("end").alias("last"), "place")


def _pieces(bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ranges into whole /16 blocks and parts of /24 blocks.

    As ranges do not overlap there are at most 65,536 whole blocks, and a /24
    block holds at most 256 parts; a lookup never meets more than that.
    """
    first, last = F.col("first"), F.col("last")
    low, high = F.ceil(first / 65536), F.floor((last + 1) / 65536) - 1
    sided = bounds.withColumns({"low": low.cast("bigint"), "high": high.cast("bigint")})
    whole = sided.filter("low <= high").select(
        F.explode(F.sequence("low", "high")).alias("block16"), F.col("place").alias("place16")
    )
    edge = F.when(
        F.col("low") <= F.col("high"),
        F.array(
            F.struct(first.alias("a"), (F.col("low") * 65536 - 1).alias("b")),
            F.struct(((F.col("high") + 1) * 65536).alias("a"), last.alias("b")),
        ),
    ).otherwise(F.array(F.struct(first.alias("a"), last.alias("b"))))
    parts = (
        sided.select("place", F.inline(edge))
        .filter("a <= b")
        .select("place", "a", "b", F.explode(F.sequence(F.shiftright("a", 8), F.shiftright("b", 8))).alias("block24"))
        .select(
            "block24",
            F.greatest("a", F.col("block24") * 256).alias("first24"),
            F.least("b", F.col("block24") * 256 + 255).alias("last24"),
            F.col("place").alias("place24"),
        )
    )
    return whole, parts


def check_ranges(ranges: DataFrame) -> DataFrame:
    """Return the ranges in numeric form; refuse malformed or overlapping ones.

    Overlaps are looked for block by block, so no task sorts the whole table.
    """
    bounds = _bounds(ranges)
    valid = F.coalesce(F.expr("0 <= first AND first <= last AND last <= 4294967295"), F.lit(False))
    malformed = bounds.filter(~valid).select(
        F.concat_ws(" ", F.lit("malformed range:"), "first", "last", "place").alias("problem")
    )
    whole, parts = _pieces(bounds.filter(valid))
    twice = whole.groupBy("block16").count().filter("count > 1").select("block16")
    inside = parts.select(F.shiftright("block24", 8).alias("block16")).join(whole, "block16", "left_semi")
    previous = F.max("last24").over(
        Window.partitionBy("block24").orderBy("first24").rowsBetween(Window.unboundedPreceding, -1)
    )
    crossing = parts.withColumn("previous", previous).filter("first24 <= previous")
    clashes = twice.union(inside).union(crossing.select(F.shiftright("block24", 8)))
    block = F.concat_ws(".", F.shiftright("block16", 8), F.col("block16") % 256, F.lit("0"), F.lit("0/16"))
    overlapping = clashes.select(F.concat_ws(" ", F.lit("ranges overlap within"), block))
    problem = malformed.union(overlapping).first()
    if problem:
        raise ValueError(problem[0])
    return bounds


def locate(df: DataFrame, ranges: DataFrame, col: str = "ip") -> DataFrame:
    """Add the ``place`` of each client; null for host names and unknown addresses.

    ``ranges`` has ``start`` and ``end`` (dotted or numeric, inclusive, without
    overlap) and ``place``. The split ranges are stored once, so Spark knows their size
    and broadcasts them below its own threshold; otherwise the events are joined on
    their blocks, where adaptive execution splits a hot one. Host names have no block:
    each row gets a key of its own that no range has, so they do not meet in one task.
    """
    whole, parts = _pieces(check_ranges(materialise(ranges.select("start", "end", "place"))))
    whole, parts = materialise(whole), materialise(parts)
    located = df.withColumn("_address", ipv4_to_long(F.col(col)))
    nowhere = -1 - F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(1 << 30))
    located = located.withColumns({
        "_block24": F.coalesce(F.shiftright("_address", 8), nowhere),
        "_block16": F.coalesce(F.shiftright("_address", 16), nowhere),
    })
    located = located.join(
        parts, (F.col("_block24") == F.col("block24")) & F.col("_address").between(F.col("first24"), F.col("last24")), "left"
    )
    located = located.join(whole, F.col("_block16") == F.col("block16"), "left")
    return located.select(*[F.col(f"`{name}`") for name in df.columns], F.coalesce("place24", "place16").alias("place"))


def _masked(key: Column, length: int) -> Column:
    """The prefix of ``length`` bits of an address."""
    high, low = prefix_mask(length)
    return F.struct(
        F.lit(length).alias("bits"),
        key["high"].bitwiseAND(F.lit(high).cast("bigint")).alias("high"),
        key["low"].bitwiseAND(F.lit(low).cast("bigint")).alias("low"),
    )


def _prefixes(networks: DataFrame) -> DataFrame:
    """Networks as (bits, high, low, place); refuses malformed ones and prefixes given twice."""
    base, length = F.split_part("network", F.lit("/"), F.lit(1)), F.split_part("network", F.lit("/"), F.lit(2))
    mapped = F.when(base.contains(":"), 0).otherwise(96)
    longest = F.when(base.contains(":"), 128).otherwise(32)
    # Without a length a network is one address.
    given = F.when(F.col("network").contains("/"), F.when(length.rlike(r"^\d{1,3}$"), length.cast("int"))).otherwise(longest)
    rows = networks.select("network", "place", ip_key(base).alias("key"), given.alias("given"), mapped.alias("mapped"), longest.alias("longest"))
    rows = rows.withColumn("bits", F.when(F.col("given") <= F.col("longest"), F.col("given") + F.col("mapped")))
    masks = F.array(*[F.struct(*[F.lit(half).cast("bigint").alias(n) for half, n in zip(prefix_mask(b), ("high", "low"))]) for b in range(129)])
    rows = rows.withColumn("mask", F.get(masks, F.col("bits")))
    mask = F.col("mask")
    inside = (F.col("key.high").bitwiseAND(mask["high"]) == F.col("key.high")) & (F.col("key.low").bitwiseAND(mask["low"]) == F.col("key.low"))
    rows = materialise(rows.select(
        "network", "place", "bits", "key.high", "key.low",
        F.coalesce((F.size(F.split("network", "/")) <= 2) & inside, F.lit(False)).alias("fine"),
    ))
    malformed = rows.filter(~F.col("fine")).select(F.concat_ws(" ", F.lit("malformed network:"), "network"))
    twice = rows.filter("fine").groupBy("bits", "high", "low").agg(F.count("*").alias("n"), F.min("network").alias("network"))
    problem = malformed.union(twice.filter("n > 1").select(F.concat(F.lit("network given twice: "), "network"))).first()
    if problem:
        raise ValueError(problem[0])
    return rows.select("bits", "high", "low", "place")


def locate_networks(df: DataFrame, networks: DataFrame, col: str = "ip") -> DataFrame:
    """Add the ``place`` of each client of either family: that of the longest network that holds it.

    ``networks`` has ``network`` (``10.0.0.0/8``, ``2001:db8::/32``, or one address) and ``place``;
    networks may lie inside each other. IPv4 is looked up in its mapped form ``::ffff:a.b.c.d``, so
    such clients match IPv4 networks too. Null for host names and for addresses outside of all.

    Each distinct address is read and looked up once, whatever its share of the rows, with one
    equality join on its prefixes of just the lengths that occur in the table (129 at most). Host
    names get join keys of their own, so they do not meet in one task.
    """
    prefixes = _prefixes(networks.select("network", "place"))
    lengths = sorted(r["bits"] for r in prefixes.select("bits").distinct().collect())  # 129 rows at most
    if not lengths:
        return df.select(*[F.col(f"`{name}`") for name in df.columns], F.lit(None).cast("string").alias("place"))
    client = F.col(f"`{col}`")
    clients = df.select(client.alias("_client")).filter(client.rlike(ADDRESS_TEXT)).distinct().withColumn("key", ip_key(F.col("_client")))
    tried = clients.select("_client", F.inline(F.array(*[_masked(F.col("key"), n) for n in lengths])))
    found = tried.join(prefixes, ["bits", "high", "low"]).groupBy("_client").agg(F.max_by("place", "bits").alias("_place"))
    own = F.concat(F.lit("-"), F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]))
    rows = df.withColumn("_lookup", F.when(client.rlike(ADDRESS_TEXT), client).otherwise(own))
    located = rows.join(found, F.col("_lookup") == F.col("_client"), "left")
    return located.select(*[F.col(f"`{name}`") for name in df.columns], F.col("_place").alias("place"))
