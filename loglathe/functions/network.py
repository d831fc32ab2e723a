"""Arithmetic on addresses of both families."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4_SHAPE = r"^\d{1,3}(\.\d{1,3}){3}$"


def ipv4_to_long(address: Column) -> Column:
    """A dotted address as BIGINT; null for host names and octets above 255."""
    octets = [F.split_part(address, F.lit("."), F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    number = reduce(lambda high, low: high * 256 + low, octets)
    return F.when(address.rlike(IPV4_SHAPE) & (F.greatest(*octets) <= 255), number)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; written out at each use it would be too long to compile."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _full_form(text: Column) -> Column:
    """All eight groups of an address of hexadecimal groups; null if it is none."""
    # A double colon stands for the groups that are missing, one at least.
    given = F.regexp_count(text, F.lit("[0-9a-f]+"))
    zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), 8 - given))
    filled = F.when(given < 8, F.btrim(F.replace(text, F.lit("::"), zeros), F.lit(":")))
    shape = text.rlike(r"^(::)?([0-9a-f]{1,4}(::?[0-9a-f]{1,4})*(::)?)?$")
    return F.when(shape, F.when(text.contains("::"), filled).otherwise(text))


def ip_key(address: Column) -> Column:
    """The 128 bits of an address of either family as ``struct<high bigint, low bigint>``.

    IPv4 addresses have the key of their mapped form ``::ffff:a.b.c.d``. Null for host names,
    and for texts with a zone, brackets, groups over four digits or a second ``::``.
    """

    def groups(text: Column, tail: Column) -> Column:
        # A dotted tail becomes two groups; null if it is no IPv4 address.
        quad = F.lower(F.regexp_replace(F.lpad(F.hex(ipv4_to_long(tail)), 8, "0"), r"^(.{4})", "$1:"))
        head = F.substr(text, F.lit(1), F.length(text) - F.length(tail))
        return F.when(tail.contains("."), F.concat(F.when(head == "", "::ffff:").otherwise(head), quad)).otherwise(text)

    def halves(digits: Column) -> Column:
        high, low = (F.conv(F.substr(digits, F.lit(at), F.lit(16)), 16, -10).try_cast("bigint") for at in (1, 17))
        return F.when(F.length(digits) == 32, F.struct(high.alias("high"), low.alias("low")))

    def digits(full: Column) -> Column:
        padded = F.regexp_replace(F.regexp_replace(full, r"(^|:)", "$1000"), r"0*([0-9a-f]{4})(:|$)", "$1")
        return F.when(full.rlike(r"^[0-9a-f]{1,4}(:[0-9a-f]{1,4}){7}$"), padded)

    key = lambda text: _let(_let(_full_form(text), digits), halves)
    return _let(F.lower(address), lambda t: _let(_let(F.substring_index(t, ":", -1), lambda tail: groups(t, tail)), key))


def prefix_mask(length: int) -> tuple[int, int]:
    """High and low half, as signed numbers, of the mask with ``length`` leading ones."""
    bits = ((1 << length) - 1) << (128 - length)
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    return signed(bits >> 64), signed(bits & ((1 << 64) - 1))
