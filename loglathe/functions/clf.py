"""Column functions for Common Log Format lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line format that decides which lines count as valid (seven
# groups: client, remote log name, user, time, request, status, size) and the
# time format inside the brackets.
CLF_PATTERN = r'(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"([^"]+)"\s+(\d+)\s+(\S+)'
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
CLF_WALL_CLOCK_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
CLF_TIME_SHAPE = r"^\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}$"

# A quoted field that may hold backslash-escaped quotes.
_QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'

# CLF_PATTERN again, for one pass over the line: the request group is opened up
# into its first three words, and quantifiers that cannot usefully give back
# characters are possessive. The words hold no blanks and the time holds no "]",
# which is what makes the rewritten line safe to split. A word spells out the
# blanks because Java tests a mixed class such as [^"\s] at twice the cost. A
# client that fails from its first character also fails from a later one, so only
# word starts are tried; without that a long word costs its length squared.
_CLIENT = r"(\S++)\s++(\S++)\s++(\S++)\s++"
_TIME = r"\[([^\]]++)\]\s++"
_WORD = r'([^" \t\n\x0B\f\r]*+)'
_REQUEST = rf'"(?!"){_WORD}\s*+{_WORD}\s*+{_WORD}[^"]*+"\s++'
_RESULT = r"(\d++)\s++(\S++)"
_ONE_PASS = rf"(?s)\A(?:.*?(?<!\S){_CLIENT}{_TIME}{_REQUEST}{_RESULT}(.*+)|.*+)\z"
_LAYOUT = "$1 $2 $3 $5 $6 $7 $8 $9 $4]"

# The fields of a line in order, and a pattern that takes as many of them from its start as are sound.
FIELDS = ("client", "log_name", "user", "time", "request", "status", "size")
_SOUND = r'\A(?:(\S+)(?:\s+(\S+)(?:\s+(\S+)(?:\s+\[([^\]]+)\](?:\s+"([^"]+)"(?:\s+(\d+)(?!\S)(?:\s+(\S+))?)?)?)?)?)?)?'

# Positions in the array that split_line returns.
IP, LOG_NAME, USER, METHOD, URL, PROTOCOL, STATUS, SIZE, REST = range(9)


def split_line(raw: Column, trailer: bool = False) -> Column:
    """All fields of a line as one array, with a single regex evaluation.

    A line that does not match gives an array of empty strings, so an empty
    client marks it. The last element is the time, closed by ``]``, and with
    ``trailer`` what follows the size. Words of a request that starts with a
    blank are only valid through :func:`request_word`.
    """
    layout = _LAYOUT + "$10" if trailer else _LAYOUT
    return F.split(F.regexp_replace(raw, F.lit(_ONE_PASS), F.lit(layout)), " ", 9)


def broken_field(raw: Column) -> tuple[Column, Column]:
    """The first field that a line, read from its start, has not or not in its form, and the position (from 1) where its sound part ends.

    Null and 1 behind its end for a line with all fields.
    """
    sound = [F.regexp_extract(raw, _SOUND, i + 1) != "" for i in range(len(FIELDS))]
    field = F.lit(None).cast("string")
    for name, found in reversed(list(zip(FIELDS, sound, strict=True))):
        field = F.when(~found, name).otherwise(field)
    return field, F.length(F.regexp_extract(raw, _SOUND, 0)) + 1


def request_word(fields: Column, position: int) -> Column:
    """Method, URL or protocol; all are empty when the request starts with a blank."""
    if position == METHOD:
        return fields[METHOD]
    return F.when(fields[METHOD] == "", "").otherwise(fields[position])


def time_text(fields: Column) -> Column:
    return F.substring_index(fields[REST], "]", 1)


def trailing_field(fields: Column, position: int) -> Column:
    """Referrer (1) or agent (2) of the combined format; null if absent or ``-``."""
    pattern = r"^[^\]]*\]\s+" + r"\s+".join([_QUOTED] * position)
    text = F.regexp_extract(fields[REST], pattern, position)
    return F.nullif(F.nullif(text, F.lit("")), F.lit("-"))


def parse_clf_ts(text: Column, keep_offset: bool = True) -> Column:
    """Log time to TIMESTAMP, null when malformed.

    ``keep_offset=False`` ignores the UTC offset (it must still be present) and
    reads the wall-clock time in the session zone.
    """
    if keep_offset:
        return F.try_to_timestamp(text, F.lit(CLF_TIME_FORMAT))
    wall_clock = F.try_to_timestamp(F.substring(text, 1, 20), F.lit(CLF_WALL_CLOCK_FORMAT))
    return F.when(text.rlike(CLF_TIME_SHAPE), wall_clock)


def size_bytes(text: Column) -> Column:
    """``-`` stands for no body, that is 0 bytes; anything unreadable is null."""
    return F.when(text == "-", F.lit(0).cast("bigint")).otherwise(text.try_cast("bigint"))


def hour_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:00:00")


def minute_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:00")


def clf_line(
    ip: Column,
    ts: Column,
    method: Column,
    url: Column,
    protocol: Column,
    status: Column,
    size: Column,
) -> Column:
    """One Common Log Format line; the time carries the session zone's offset."""
    return F.concat(
        ip,
        F.lit(" - - ["),
        F.date_format(ts, CLF_TIME_FORMAT),
        F.lit('] "'),
        F.concat_ws(" ", *[F.nullif(part, F.lit("")) for part in (method, url, protocol)]),
        F.lit('" '),
        status.cast("string"),
        F.lit(" "),
        F.coalesce(size.cast("string"), F.lit("-")),
    )
