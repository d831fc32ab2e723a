"""Spelling variants: words one letter apart, found by pivotal grams.

The bigrams of a word are ordered from the rarest among all words to the commonest. Its
prefix is the first three of them (and further places of the third); its pivots are two
disjoint bigrams of the prefix, chosen by dynamic programming for the least total count. One
edit spoils at most one of two disjoint bigrams. So of two near words, let the one whose
prefix ends earlier in the order give its pivots: one pivot stands unspoiled in the
other word, and as it is no later than the end of that word's prefix, it lies in the prefix.

The position limit is used in its sharpest form. What an unspoiled pivot has on one side
of it is equal in both words, and on the other side is one edit apart, so that of the two
halves of that side one is unspoiled too. The key of a pivot therefore is the bigram with all
that stands on one side and with one half of the other: words meet only if they share all
that. Pairs that meet are verified by their edit distance inside the join.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise

#: Words are of so many letters and so many occurrences at least.
LEAST_LETTERS, LEAST_TIMES = 5, 3
#: A letter is deleted from one of so many runs, chosen by crc32.
DAMAGED = 97
#: A form occurs at least so many times as often as the word it stands for.
RATIO = 2
#: Distinct words that a task counts before it passes counts on.
HELD_WORDS = 500_000
#: Bigrams of the words that a task makes keys for.
TASK_GRAMS = 400_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damaged: int | None = DAMAGED) -> DataFrame:
    """``word, n`` for all words of the texts, with every ``damaged``-th run (by crc32) one letter short.

    Runs are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case; from those whose
    crc32 with the id is a multiple of ``damaged`` the letter at that crc32 modulo their
    length is deleted. A row with a null id has all its runs undamaged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # bytes: lower() is for A-Z only
                runs = Counter(_RUN.findall((text.as_py() or b"").lower().decode("utf-8", "replace")))
                if doc_id is not None and damaged:
                    head = zlib.crc32(f"{doc_id}:".encode())
                    for run in [r for r in runs if zlib.crc32(r.encode(), head) % damaged == 0]:
                        at = zlib.crc32(run.encode(), head) % len(run)
                        # The shorter run may be a run of its own: never damaged again.
                        total[run[:at] + run[at + 1 :]] += runs.pop(run)
                total.update(runs)
                if len(total) > HELD_WORDS:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("word") != "")


def prefix(word: str, rank: dict[str, int]) -> list[int]:
    """Places of the three rarest bigrams, and of all that are as rare as the third."""
    places = sorted(range(len(word) - 1), key=lambda p: (rank[word[p : p + 2]], p))
    last = rank[word[places[2] : places[2] + 2]]
    return [p for p in places if rank[word[p : p + 2]] <= last]


def pivots(word: str, places: list[int], counts: dict[str, int]) -> tuple[int, int]:
    """Two of the places whose bigrams do not overlap, with the least total count."""
    best, single, waiting = None, None, []
    for p in sorted(places):
        # The best first pivot among places that end before this one.
        while waiting and waiting[0] <= p - 2:
            q = waiting.pop(0)
            if single is None or counts[word[q : q + 2]] < counts[word[single : single + 2]]:
                single = q
        if single is not None:
            cost = counts[word[single : single + 2]] + counts[word[p : p + 2]]
            if best is None or cost < best[0]:
                best = (cost, single, p)
        waiting.append(p)
    return best[1], best[2]


def _sides(word: str, p: int) -> Iterator[tuple[str, str]]:
    """What stands up to and behind a bigram, and from it and before it: the equal and the other side."""
    yield "<" + word[: p + 2], word[p + 2 :]
    yield ">" + word[p:], word[:p]


def index_keys(word: str, places: tuple[int, ...]) -> set[str]:
    keys = set()
    for p in places:
        for fixed, rest in _sides(word, p):
            half = len(rest) // 2
            keys |= {f"{fixed}<{rest[:half]}", f"{fixed}>{rest[half:]}"}
    return keys


def probe_keys(word: str, places: list[int]) -> set[str]:
    """The keys that a near word with one of these bigrams as pivot may have: its other side has one letter more or less, or as many."""
    keys = set()
    for p in places:
        for fixed, rest in _sides(word, p):
            m = len(rest)
            for size in range(max(m - 1, 0), m + 2):
                half = size // 2
                keys.add(f"{fixed}<{rest[:half]}")
                if size - half <= m:
                    keys.add(f"{fixed}>{rest[m - (size - half) :]}")
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``a, n_a, b, n_b`` of stored ``word, n`` that are one edit apart, each once.

    Words are distinct, of at least ``LEAST_LETTERS`` letters a-z and U+00C0 to U+00FF, so
    there are at most 8,100 bigrams: their counts are collected.
    """
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2)))
    counted = words.select(grams.alias("gram")).groupBy("gram").count().collect()
    counts = {r["gram"]: r["count"] for r in counted}
    rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows, key, pivot, ends = [], [], [], []
                for i, word in enumerate(part.column(0).to_pylist()):
                    places = prefix(word, rank)
                    end = rank[word[places[-1] : places[-1] + 2]]
                    for is_pivot, made in ((True, index_keys(word, pivots(word, places, counts))), (False, probe_keys(word, places))):
                        rows += [i] * len(made)
                        key += made
                        pivot += [is_pivot] * len(made)
                        ends += [end] * len(made)
                which = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.string()), pa.array(pivot, pa.bool_()), pa.array(ends, pa.int32()), part.column(0).take(which), part.column(1).take(which)],
                    names=["key", "pivot", "last", "word", "n"],
                )

    # Words are few and small beside their keys: more tasks than the table has files.
    spread = words.select("word", "n").repartition(max(words.sparkSession.sparkContext.defaultParallelism, sum(counts.values()) // TASK_GRAMS))
    keyed = materialise(spread.mapInArrow(keys, "key string, pivot boolean, last int, word string, n bigint"))
    side = lambda pivot, x: keyed.filter(F.col("pivot") == pivot).select(
        "key", F.col("last").alias(f"last_{x}"), F.col("word").alias(f"word_{x}"), F.col("n").alias(f"n_{x}"))
    one, two = side(True, "a"), side(False, "b")
    near = (F.abs(F.length("word_a") - F.length("word_b")) <= 1) & (F.levenshtein("word_a", "word_b", 1) == 1)
    met = one.join(two, (one["key"] == two["key"]) & (F.col("last_a") <= F.col("last_b")) & (F.col("word_a") != F.col("word_b")) & near)
    first = F.col("word_a") < F.col("word_b")
    pair = lambda w, v: F.struct(F.col(f"word_{w}").alias("a"), F.col(f"n_{w}").alias("n_a"), F.col(f"word_{v}").alias("b"), F.col(f"n_{v}").alias("n_b"))
    return met.select(F.when(first, pair("a", "b")).otherwise(pair("b", "a")).alias("p")).select("p.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each stored ``word, form``: the last form of the chain.

    Forms are ever more frequent, so there are no circles and chains are short. Each round is
    a written table and doubles the steps taken.
    """
    found = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        step = found.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = materialise(found.join(step, found["root"] == step["at"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        found = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return found


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damaged: int | None = DAMAGED) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of at least five letters and three occurrences.

    Two words are near if one letter more, less or replaced makes them equal. The form of a
    word is its most frequent near word (ties: the first in code-point order), if that occurs
    twice as often at least; ``root`` follows forms to the end. Null and empty texts have
    no words, repeated rows count each time, a null id takes part undamaged, an empty table has no
    words. Texts are read whole. Other columns are not read.
    """
    words = count_words(docs, id_col, text_col, damaged)
    words = materialise(words.filter((F.length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_TIMES)))
    pairs = materialise(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best"))
    form_n = -F.col("best.minus")
    shown = form_n >= RATIO * F.col("n")
    found = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(shown, F.col("best.form")).alias("form"), F.when(shown, form_n).alias("form_n")
    ))
    ends = roots(found.filter("form IS NOT NULL")).withColumnRenamed("word", "of")
    return found.join(ends, found["word"] == ends["of"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their spelling variants."""
    return variants(load(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE steps AS (  -- the 256 steps of crc32, from its polynomial
  SELECT list(c ORDER BY i) AS s FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
  )
),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
  ) GROUP BY ALL
),
hashed AS (
  SELECT run, times, coalesce(xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, x: xor(c >> 8, s[(xor(c, x) & 255) + 1])), 4294967295::BIGINT), 1) AS h
  FROM runs, steps
),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0
      THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word
    FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND n >= 3
),
cut AS (  -- near words share the word itself or what is left of it without one letter
  SELECT word, n, word AS part FROM words
  UNION
  SELECT word, n, substr(word, 1, i) || substr(word, i + 2) FROM (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM words)
),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.part = b.part AND a.word <> b.word
  WHERE (length(a.word) = length(b.word) AND list_sum(list_transform(range(1, length(a.word) + 1), lambda i: (substr(a.word, i::INTEGER, 1) <> substr(b.word, i::INTEGER, 1))::INTEGER)) = 1)
    OR (length(a.word) = length(b.word) + 1 AND a.part = b.word)
    OR (length(b.word) = length(a.word) + 1 AND b.part = a.word)
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT chain.word, f.form FROM chain JOIN formed f ON chain.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain c USING (word) JOIN formed e ON e.word = c.at WHERE e.form IS NULL
"""
