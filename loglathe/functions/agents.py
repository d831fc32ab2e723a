"""Browser and device classes, and the products, of a user-agent text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, first match wins: most browsers also name the ones they imitate.
BROWSERS = [
    ("Bot", r"(?i)bot|crawl|spider|slurp"),
    ("Edge", r"Edg(e|A|iOS)?/"),
    ("Opera", r"OPR/|Opera"),
    ("Firefox", r"Firefox/|FxiOS/"),
    ("Chrome", r"Chrome/|CriOS/|Chromium/"),
    ("Safari", r"Version/.*Safari/"),
    ("Internet Explorer", r"MSIE |Trident/"),
    ("Command line", r"^(curl|Wget)/"),
]
DEVICES = [
    ("Bot", r"(?i)bot|crawl|spider|slurp"),
    ("Tablet", r"iPad|Tablet|Kindle"),
    ("Mobile", r"Mobi|iPhone|Android"),
    ("Desktop", r"Windows NT|Macintosh|X11|CrOS"),
]

# Product tokens that browsers name for the sake of compatibility.
IMITATED = ["Mozilla", "AppleWebKit", "KHTML", "Gecko", "Safari", "Version", "Mobile", "Chrome", "Chromium"]
# Systems as agents write them, the more special first.
SYSTEMS = [
    ("Windows Phone", r"Windows Phone(?: OS)? (\d[\d.]*)"), ("Windows", r"Windows(?: NT)?(?: (\d[\d.]*))?"),
    ("Android", r"Android(?:[ /](\d[\d.]*))?"), ("iOS", r"(?:iPhone OS|CPU OS) (\d[\d_.]*)"),
    ("macOS", r"Mac OS X(?: (\d[\d_.]*))?"), ("ChromeOS", r"CrOS \S+ (\d[\d.]*)"), ("Linux", r"Linux()"),
]


def _first_match(text: Column, classes) -> Column:
    result = F.when(text.isNull(), "None")
    for label, pattern in classes:
        result = result.when(text.rlike(pattern), label)
    return result.otherwise("Other")


def browser(agent: Column) -> Column:
    return _first_match(agent, BROWSERS)


def device(agent: Column) -> Column:
    return _first_match(agent, DEVICES)


def agent_details(agent: Column) -> Column:
    """``struct<product, version, platform, platform_version, bot>`` of an agent text; null if none was sent.

    The text is read as product tokens ``name/version`` with comments in parentheses. The product is
    what follows ``compatible;`` in a comment, else the first token, or, as almost all browsers start with
    ``Mozilla``, the last token that others do not imitate, then Chrome, then Safari. Safari and
    Opera give their version in a token of its own. A text without tokens is its own first word.
    """
    plain = F.regexp_replace(F.regexp_replace(agent, r"\([^()]*\)", " "), r"\([^()]*\)", " ")
    token = F.lit(r"([^\s/;,()]+)/v?(\d[^\s;,()]*)")
    names, versions = (F.regexp_extract_all(plain, token, F.lit(group)) for group in (1, 2))
    tokens = F.transform(names, lambda name, i: F.struct(name.alias("name"), F.get(versions, i).alias("version")))

    def last(which: Callable[[Column], Column]) -> Column:
        kept = F.filter(tokens, lambda t: which(t["name"]))
        return F.get(kept, F.size(kept) - 1)

    compatible = r"\([^()]*compatible;\s*([^;()]+?)(?:[ /]v?(\d[^;()\s]*))?\s*[;)]"
    named = F.when(agent.rlike(compatible), F.struct(
        F.regexp_extract(agent, compatible, 1).alias("name"),
        F.nullif(F.regexp_extract(agent, compatible, 2), F.lit("")).alias("version")))
    explorer = F.when(agent.rlike(r"Trident/.*rv:\d"), F.struct(
        F.lit("MSIE").alias("name"), F.regexp_extract(agent, r"Trident/.*rv:([\d.]+)", 1).alias("version")))
    word = F.struct(F.regexp_extract(agent, r"^\s*([^\s/;,()]+)", 1).alias("name"), F.lit(None).cast("string").alias("version"))
    first = F.get(tokens, F.lit(0))
    own = F.when(first["name"] != "Mozilla", first)
    found = F.coalesce(
        named, explorer, own, last(lambda n: ~n.isin(IMITATED)), last(lambda n: n.isin("Chrome", "Chromium")), last(lambda n: n == "Safari"), first, word)
    stated = last(lambda n: n == "Version")["version"]
    version = F.when(found["name"].isin("Safari", "Opera"), F.coalesce(stated, found["version"])).otherwise(found["version"])
    platform, number = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name, pattern in SYSTEMS:
        here = agent.rlike(pattern)
        platform = platform.when(here, name)
        number = number.when(here, F.nullif(F.translate(F.regexp_extract(agent, pattern, 1), "_", "."), F.lit("")))
    bot = agent.rlike(BROWSERS[0][1]) | agent.contains("+http")
    details = F.struct(
        F.nullif(found["name"], F.lit("")).alias("product"), version.alias("version"),
        platform.alias("platform"), number.alias("platform_version"), bot.alias("bot"))
    return F.when(agent.isNotNull(), details)


def referrer_host(referrer: Column) -> Column:
    """The host of a referring page, lower case; the text itself if it is no URL."""
    host = F.nullif(F.regexp_extract(referrer, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1), F.lit(""))
    return F.lower(F.coalesce(host, referrer))
