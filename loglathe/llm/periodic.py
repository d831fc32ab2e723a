"""Runs of words that repeat with a period, by multi-scale minimizers.

A run is a stretch of words in which words one period apart are equal, at least three
periods long, and not extendable. Periods below ``DIRECT`` are found by comparing the text
with itself at each lag. For longer ones there is one scale for each power of two: the
periods from 2s to 4s are looked for with word grams of s words and windows of s places.
The places that hold the least gram hash of some window repeat inside a run at the distance
of its period, so equal least grams at such a distance are seeds, and each seed is extended
word by word to both sides.

No run is lost. A run of period p has at least p + 1 windows whose copy one period on lies
in it as well. Grams that repeat inside themselves (a third of their length or less apart)
are left out; they lie in runs of shorter periods, found before, and a run whose places are
all of that kind would have that shorter period itself. So one of those windows has a least
gram left, and its copy has the same one. What is left out also bounds the work: equal grams
that remain are more than a third of their length apart, so a place has few partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load
from .line_dedup import _bind

#: A run has at least so many words, and so many periods.
LEAST_WORDS, REPEATS = 24, 3
#: Periods below are looked for at their own lag.
DIRECT = 8
#: Words of the texts that are worked on together; one longer text is taken alone.
CHUNK_WORDS = 1 << 19


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return x ^ (x >> np.uint64(29))


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places on; 0 beyond the end."""
    out = np.zeros_like(x)
    out[: len(x) - by] = x[by:]
    return out


def _least_of_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Which places hold the least value of some window of ``width`` (a power of two) places."""
    low, step = x, 1
    while step < width:
        low = np.concatenate([np.minimum(low[:-step], low[step:]), low[-step:]])
        step *= 2
    high, step = low, 1
    while step < width:  # the greatest minimum of the windows that a place lies in
        high = np.concatenate([high[:step], np.maximum(high[step:], high[:-step])])
        step *= 2
    return high == x


def _same_extent(ids: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The stretch of places around ``place`` that equal the place ``lag`` further on."""
    end, step = place, max(64, 2 * lag)
    while True:
        b = ids[end + lag : end + lag + step]
        differ = ids[end : end + len(b)] != b
        if differ.any():
            end += int(differ.argmax())
            break
        end += len(b)
        if len(b) < step:
            break
        step *= 2
    start, step = place, max(64, 2 * lag)
    while start > 0:
        low = max(0, start - step)
        differ = (ids[low:start] != ids[low + lag : start + lag])[::-1]
        if differ.any():
            start -= int(differ.argmax())
            break
        start, step = low, step * 2
    return start, end


def _is_smallest(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether a run has no smaller period. A smaller one would divide ``period``, as the run holds it three times."""
    left, factor = period, 2
    while left > 1:
        if left % factor == 0:
            lag = period // factor
            end = start + length - lag
            if ids[start] == ids[start + lag] and np.array_equal(ids[start:end], ids[start + lag : end + lag]):
                return False
            while left % factor == 0:
                left //= factor
        factor = factor + 1 if factor * factor <= left else left
    return True


def _direct(ids: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Start and length of the runs of period ``lag``, by comparing all places."""
    at = np.flatnonzero(ids[:-lag] == ids[lag:])
    if not len(at):
        return
    breaks = np.flatnonzero(np.diff(at) > 1)
    starts, ends = at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])] + 1
    long = ends - starts >= (REPEATS - 1) * lag
    for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        if _is_smallest(ids, s, e - s + lag, lag):
            yield s, e - s + lag


def _seeds(grams: np.ndarray, usable: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags, sorted by lag and place, where least grams of ``size`` words repeat 2 to 4 sizes on."""
    shown = np.where(usable, grams, np.uint64(2**64 - 1))
    at = np.flatnonzero(_least_of_windows(shown, size) & usable)
    order = np.argsort(grams[at], kind="stable")
    at, value = at[order], grams[at][order]
    found, lags, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    first = np.arange(len(at))
    while True:
        first = first[first + step < len(at)]
        lag = at[first + step] - at[first]
        first = first[near] if len(near := np.flatnonzero((value[first + step] == value[first]) & (lag < 4 * size))) else first[:0]
        if not len(first):
            break
        lag = at[first + step] - at[first]
        far = lag >= 2 * size
        found.append(at[first][far]), lags.append(lag[far])
        step += 1
    place, lag = np.concatenate(found), np.concatenate(lags)
    # A run of three periods around the seed holds the period before it or the one behind it.
    n = len(grams)
    behind = np.minimum(place + 2 * lag - size, n - 1)
    same = (grams[place + lag - size] == grams[behind]) & (place + 2 * lag <= n)
    same |= (grams[np.maximum(place - lag, 0)] == grams[place]) & (place >= lag)
    place, lag = place[same], lag[same]
    order = np.lexsort((place, lag))
    return place[order], lag[order]


def runs_of(codes: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """All runs of at least three periods in each list of word codes (0 and above): start, length, smallest period.

    Lists are worked on together, with a code of its own behind each so that nothing spans two.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in codes]
    sizes = np.array([len(c) for c in codes], np.int64)
    docs = np.flatnonzero(sizes >= REPEATS)
    if not len(docs):
        return out
    ids = np.concatenate([np.append(codes[d], -1 - d) for d in docs.tolist()])
    starts = np.cumsum(sizes[docs] + 1) - sizes[docs] - 1

    def keep(start: int, length: int, period: int) -> None:
        d = int(np.searchsorted(starts, start, side="right")) - 1
        out[docs[d]].append((start - int(starts[d]), length, period))

    for lag in range(1, min(DIRECT, len(ids))):
        for start, length in _direct(ids, lag):
            keep(start, length, lag)
    grams, size = _mixed(ids.view(np.uint64), np.full(len(ids), 7, np.uint64)), 1
    while True:
        if 2 * size >= DIRECT:
            long = sizes[docs] >= REPEATS * 2 * size
            if not long.any():
                return out
            if not long.all():  # only texts that can hold three periods go on
                mask = np.repeat(long, sizes[docs] + 1)
                ids, grams, docs = ids[mask], grams[mask], docs[long]
                starts = np.cumsum(sizes[docs] + 1) - sizes[docs] - 1
            inner = np.zeros(len(ids) + 1, np.int64)
            for d, start in zip(docs.tolist(), starts.tolist(), strict=True):
                for s, length, period in out[d]:
                    if period * 3 <= size <= length:
                        inner[start + s] += 1
                        inner[start + s + length - size + 1] -= 1
            last_lag, last_end = 0, 0
            for place, lag in zip(*(x.tolist() for x in _seeds(grams, np.cumsum(inner[:-1]) == 0, size)), strict=True):
                if lag == last_lag and place < last_end:
                    continue
                s, e = _same_extent(ids, place, lag)
                last_lag, last_end = lag, e
                if e - s >= (REPEATS - 1) * lag and _is_smallest(ids, s, e - s + lag, lag):
                    keep(s, e - s + lag, lag)
        grams = _mixed(grams, _shifted(grams, size)) if size < len(grams) else grams
        size *= 2


def _found(batch_ids: list[int], texts: list[list[bytes]]) -> dict[str, list]:
    known: dict[bytes, int] = {}
    codes = [np.array([known.setdefault(w, len(known)) for w in words], np.int64) for words in texts]
    rows: dict[str, list] = {"row": batch_ids, "n_words": [len(w) for w in texts], "runs": [], "collapsed": []}
    for words, all_runs in zip(texts, runs_of(codes), strict=True):
        runs = sorted((r for r in all_runs if r[1] >= LEAST_WORDS), key=lambda r: (r[0], r[2]))
        if runs:
            kept = np.ones(len(words), bool)
            for start, length, period in runs:
                kept[start + period : start + length] = False
            words = [words[i] for i in np.flatnonzero(kept).tolist()]
        rows["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in runs])
        rows["collapsed"].append(b" ".join(words))
    return rows


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs``.

    Words are what ASCII white space separates, compared byte by byte. ``runs`` lists
    ``start, length, period`` (word numbers from 0) of all runs of at least 24 words and
    three periods, by start and period. ``collapsed`` is the text with one space between
    words, without the words that lie in a run behind its first period.

    Null, empty and blank texts have no words: no runs, an empty ``collapsed``. A null id
    is an id like others, repeated rows are rows of their own, an empty table gives no
    rows. Texts of any length are read whole, each in one task. Other columns are not read.
    """
    from pyspark.sql.types import StructField, StructType

    id_type = docs.schema[id_col].dataType
    found_type = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    schema = StructType([StructField("doc_id", id_type), *StructType.fromDDL(found_type)])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or b"").split()
                ids.append(i), texts.append(words)
                held += len(words) + 1
                if held >= CHUNK_WORDS or i == batch.num_rows - 1:
                    got = _found(ids, texts)
                    columns = [batch.column(0).take(pa.array(got["row"], pa.int64())), pa.array(got["n_words"], pa.int64())]
                    columns += [pa.array(got["runs"], run_type), pa.array(got["collapsed"], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
                    ids, texts, held = [], [], 0

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(find, schema)
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``, where a tenth of the texts, chosen by the id's crc32, repeat a stretch to their end.

    With ``h`` the crc32, ``g = h div 10`` and ``n`` words, each word ``i >= a`` becomes word
    ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. Texts
    without words and rows with a null id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), "[ \\x09-\\x0D]+"), lambda w: w != "")

    def periodic(s: Column) -> Column:
        w, a, p = s["w"], s["a"], s["p"]
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)), " ")

    def shaped(s: Column) -> Column:
        n, g = F.size(s["w"]), s["g"]
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.when(n > 0, _bind(F.struct(s["w"].alias("w"), a.alias("a"), p.alias("p")), periodic)).otherwise("")

    planted = _bind(F.struct(words.alias("w"), F.floor(h / 10).alias("g")), shaped)
    chosen = (h % 10 == 0) & F.col(text_col).isNotNull()
    return docs.select(F.col(id_col).alias("doc_id"), F.when(chosen, planted).otherwise(F.col(text_col)).alias("text"))


def op11_multiscale_minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them with a planted one."""
    found = periodic_runs(with_planted_runs(load(spark, sf_dir, "documents")))
    # length/period by cross multiplication: exact.
    order = F.expr("""array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period <> y.length * x.period THEN CASE WHEN x.length * y.period > y.length * x.period THEN -1 ELSE 1 END
        WHEN x.start <> y.start THEN CASE WHEN x.start < y.start THEN -1 ELSE 1 END
        WHEN x.period <> y.period THEN CASE WHEN x.period < y.period THEN -1 ELSE 1 END ELSE 0 END)""")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", F.get(order, F.lit(0)))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
