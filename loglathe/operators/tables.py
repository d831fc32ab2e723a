"""Look-ups and maintenance over stored rows."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import table_for


def search(
    df: DataFrame, where: Column | str, order_by: Sequence[Column | str] | None = None, size: int = 100
) -> DataFrame:
    """The first ``size`` rows that satisfy ``where``, in the given order."""
    hits = df.filter(where)
    if order_by:
        hits = hits.orderBy(*order_by)
    return hits.limit(size)


def search_text(df: DataFrame, cols: Sequence[str], terms: Sequence[str] | str, match: str = "all") -> DataFrame:
    """Rows whose text columns hold all (or any) of the terms as whole words.

    Words are runs of letters and digits of any script, compared without regard to case.
    """
    if match not in ("all", "any"):
        raise ValueError(f"match must be all or any, not {match!r}")
    given = [terms] if isinstance(terms, str) else list(terms)
    wanted = sorted({word for term in given for word in re.split(r"[\W_]+", term.lower()) if word})
    if not wanted:
        raise ValueError("no search term given")
    text = F.lower(F.concat_ws(" ", *cols))
    # The substring test is cheap and rules out most rows before they are split.
    hits = [
        F.contains(text, F.lit(word)) & F.array_contains(F.split(text, r"[^\p{L}\p{N}\p{M}]+"), word) for word in wanted
    ]
    condition = hits[0]
    for hit in hits[1:]:
        condition = condition & hit if match == "all" else condition | hit
    return df.filter(condition)


def search_ranked(
    df: DataFrame,
    cols: Sequence[str],
    terms: Sequence[str] | str,
    size: int = 10,
    order_by: Sequence[Column | str] = (),
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """The ``size`` best rows for the terms, with a ``score``; rows with none of them are left out.

    A term of several words is a phrase: it counts where they follow each other. The score is
    the BM25 sum over terms: ``ln(1 + (N - n + 0.5) / (n + 0.5)) * f * (k1 + 1) / (f + k1 * (1 - b + b * len / avg))``
    with f occurrences in a row of len words, n rows that hold the term, N rows of avg words. Words are
    those of :func:`search_text`; the text columns are taken together. Equal scores follow ``order_by``.

    Two passes: one aggregate for the statistics (one row, two numbers and one for each term), then
    the best rows of each task are merged. Nothing is shuffled by row.
    """
    given = [terms] if isinstance(terms, str) else list(terms)
    phrases = list(dict.fromkeys(tuple(w for w in re.split(r"[\W_]+", t.lower()) if w) for t in given))
    phrases = [p for p in phrases if p]
    if not phrases:
        raise ValueError("no search term given")
    clash = [c for c in df.columns if c == "score" or c.startswith("_search_")]
    if clash:
        raise ValueError(f"columns {clash} are taken by the search")

    def count(phrase: tuple[str, ...]) -> Column:
        def here(word: Column, i: Column) -> Column:
            hit = word == phrase[0]
            for step, other in enumerate(phrase[1:], 1):
                hit = hit & F.coalesce(F.get("_search_words", i + step) == other, F.lit(False))
            return hit

        return F.size(F.filter("_search_words", here))

    text = F.lower(F.concat_ws(" ", *[F.col(f"`{c}`") for c in cols]))
    names = [f"_search_{i}" for i in range(len(phrases))]
    rows = df.withColumn("_search_words", F.filter(F.split(text, r"[^\p{L}\p{N}\p{M}]+"), lambda w: w != ""))
    rows = rows.withColumns({"_search_len": F.size("_search_words"), **{n: count(p) for n, p in zip(names, phrases)}})
    stats = rows.agg(
        F.count("*").alias("rows"), F.avg("_search_len").alias("words"), *[F.count_if(F.col(n) > 0).alias(n) for n in names]
    ).first()
    length = 1 - b + b * F.col("_search_len") / F.lit(stats["words"] or 1.0)
    parts = []
    for n in names:
        weight = math.log(1 + (stats["rows"] - stats[n] + 0.5) / (stats[n] + 0.5))
        parts.append(F.lit(weight) * F.col(n) * (k1 + 1) / (F.col(n) + k1 * length))
    hits = rows.filter(F.greatest(*names, F.lit(0)) > 0).withColumn("score", sum(parts[1:], parts[0]))
    return hits.select(*[F.col(f"`{c}`") for c in df.columns], "score").orderBy(F.desc("score"), *order_by).limit(size)


def table_stats(df: DataFrame, ts_col: str) -> DataFrame:
    """Row count and covered time of a table, one row."""
    return df.agg(
        F.count("*").alias("row_count"), F.min(ts_col).alias("first_time"), F.max(ts_col).alias("last_time")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key.

    Spark turns the rank filter into a group limit that runs before the shuffle,
    so each task sends one row per key however often the key occurs.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def upsert(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: str | None = "processed_at"
) -> DataFrame:
    """``current`` with the rows of ``updates`` added or put in place by key.

    An update always wins over a current row; among several of one key the one
    with the greatest ``order_by`` does.
    """
    both = current.withColumn("_source", F.lit(0)).unionByName(updates.withColumn("_source", F.lit(1)))
    newest = [F.desc("_source")]
    if order_by:
        newest.append(F.desc_nulls_last(order_by))
    # A total order: equal stamps must not give a different row on a retry.
    rest = [name for name in current.columns if name not in keys and name != order_by]
    newest += [F.desc(name) for name in rest]
    return latest_per_key(both, keys, newest).drop("_source")


def retain(df: DataFrame, ts_col: str, days: int, as_of: datetime | date | str | None = None) -> DataFrame:
    """Rows not older than ``days`` days before ``as_of`` (default: now)."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.filter(F.col(ts_col) >= moment - F.make_dt_interval(F.lit(days)))


def refusal_reasons(refused: DataFrame, analysis: str) -> DataFrame:
    """Refused documents with the first ``field`` that does not fit the table, its ``value`` and the ``expected`` type.

    All three are null where every value, read from the document's text, fits: the target had another reason.
    """
    misfits = []
    for field in table_for(analysis).schema.fields:
        value = F.get_json_object("document", f"$.{field.name}")
        misfit = F.struct(F.lit(field.name).alias("field"), value.alias("value"), F.lit(field.dataType.simpleString()).alias("expected"))
        misfits.append(F.when(value.isNotNull() & value.try_cast(field.dataType).isNull(), misfit))
    return refused.withColumn("_misfit", F.coalesce(*misfits)).select(*refused.columns, "_misfit.*")
