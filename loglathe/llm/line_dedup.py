"""Repeated passages, found as windows of three consecutive lines.

Only DataFrame functions: lines are hashed in overlapping windows, a hash aggregate finds
the first place of each repeated window, and every other place is a later occurrence.
Their line ranges are merged per document and cut out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise

WINDOW_LINES = 3
_BLANKS = " \t\n\x0b\x0c\r"


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: lambda bodies would evaluate it per element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW_LINES) -> DataFrame:
    """``doc_id, text_key, place, first, last, h1, h2`` for each run of ``width`` lines that are not blank.

    ``first`` and ``last`` are line numbers. Lines are compared without the ASCII white
    space around them; two 64-bit hashes make an accidental match out of reach.
    """
    numbered = F.transform(_lines(F.col(text_col)), lambda line, i: F.struct(i.alias("at"), F.trim(line, F.lit(_BLANKS)).alias("line")))
    filled = F.filter(numbered, lambda x: x["line"] != "")

    def of_lines(a: Column) -> Column:
        def window(k: Column) -> Column:
            lines = [a[k + j]["line"] for j in range(width)]
            return F.struct(
                k.cast("int").alias("place"), a[k]["at"].alias("first"), a[k + (width - 1)]["at"].alias("last"),
                F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit("second"), *reversed(lines)).alias("h2"),
            )

        return F.when(F.size(a) >= width, F.transform(F.sequence(F.lit(0), F.size(a) - width), window))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.explode(_bind(filled, of_lines)).alias("w"))
    return rows.select("doc_id", "text_key", "w.*")


def later_occurrences(found: DataFrame) -> DataFrame:
    """The windows that occur earlier too: in a document with a smaller id, or above in the same one.

    A window in a third of all documents is combined before the shuffle; the join back
    has one row per repeated window on its other side, so a hot key can be split.
    """
    place = F.struct("doc_id", "text_key", "place")
    repeated = found.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(place).alias("earliest")).filter("times > 1")
    return found.join(repeated.select("h1", "h2", "earliest"), ["h1", "h2"]).filter(~place.eqNullSafe(F.col("earliest")))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW_LINES) -> DataFrame:
    """``docs`` as ``row``, with ``lines``, ``removed`` (merged line ranges) and the remaining ``text``.

    A line goes if it lies in a later occurrence of any window, so each line that goes
    has a copy that stays at an earlier place. Texts with fewer than ``width`` lines that
    are not blank have no window and stay as they are; a null text stays null, a null id
    counts as the smallest. Rows that repeat both id and text are one document: they get
    the same result. All columns of ``docs`` are carried in the struct ``row``.
    """
    later = later_occurrences(materialise(windows(docs, id_col, text_col, width)))
    ranges = later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    ranges = ranges.select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "ranges")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    on = F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("text_key") == F.col("cut_key"))
    joined = rows.join(ranges, on, "left")

    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["first"], r["last"])))))

    def rest(s: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), s["covered"])
        text = _bind(kept, lambda ks: F.array_join(F.transform(ks, lambda i: s["lines"][i]), "\n"))
        starts = F.filter(s["covered"], lambda x, i: (i == 0) | (F.get(s["covered"], i - 1) != x - 1))
        ends = F.filter(s["covered"], lambda x, i: F.coalesce(F.get(s["covered"], i + 1) != x + 1, F.lit(True)))
        spans = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
        return F.struct(text.alias("text"), spans.alias("removed"))

    whole = F.struct(F.col("text"), F.array().cast("array<struct<first:int,last:int>>").alias("removed"))
    cut = F.when(F.col("ranges").isNull(), whole).otherwise(
        _bind(F.struct(_lines(F.col("text")).alias("lines"), covered.alias("covered")), rest)
    )
    return joined.select("row", F.size(_lines(F.col("text"))).alias("lines"), cut.alias("cut")).select(
        "row", F.when(F.col("row").getField(text_col).isNotNull(), F.col("lines")).alias("lines"), "cut.removed", "cut.text"
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with its columns, repeated passages cut out of the text."""
    done = cut_repeats(docs, id_col, text_col, width)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier document has."""
    done = cut_repeats(load(spark, sf_dir, "documents"))
    ranges = F.transform("removed", lambda r: F.concat(r["first"].cast("string"), F.lit("-"), r["last"].cast("string")))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + (r["last"] - r["first"] + 1))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), F.col("lines").cast("bigint").alias("n_lines"), gone.alias("removed_lines"),
        F.array_join(ranges, ",").alias("removed"), "text",
    )


OP2_SQL = r"""
WITH numbered AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents
),
filled AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM numbered
),
windows AS (
  SELECT doc_id, pos AS first,
         lead(pos, 2) OVER w AS last,
         [body, lead(body) OVER w, lead(body, 2) OVER w] AS lines
  FROM filled WHERE body <> ''
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lines ORDER BY doc_id, first) AS occurrence
  FROM windows WHERE last IS NOT NULL
),
covered AS (
  SELECT DISTINCT n.doc_id, n.pos
  FROM numbered n JOIN placed p ON n.doc_id = p.doc_id AND n.pos BETWEEN p.first AND p.last
  WHERE p.occurrence > 1
),
islands AS (
  SELECT doc_id, min(pos) AS a, max(pos) AS b
  FROM (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM covered) t
  GROUP BY doc_id, g
),
spans AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed, sum(b - a + 1)::BIGINT AS gone
  FROM islands GROUP BY doc_id
),
kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.pos) AS rest
  FROM numbered n ANTI JOIN covered c ON n.doc_id = c.doc_id AND n.pos = c.pos
  GROUP BY n.doc_id
)
SELECT d.doc_id, len(string_split(d.text, chr(10))) AS n_lines,
       coalesce(s.gone, 0) AS removed_lines, coalesce(s.removed, '') AS removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.rest, '') END AS text
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
