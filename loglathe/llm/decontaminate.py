"""Benchmark passages in documents, also with other numbers, names and units.

Texts become template tokens: numbers, names and units turn into typed placeholders.
Windows of template tokens are hashed and joined with those of the benchmark, and so are
windows of the tokens' own lower-cased text. Items that differ in their values alone are one
class, which is joined and judged once however many items it has. Matching windows count
together if they lie on one alignment of document and class. A value of the item stands for one value of the
document: windows that hold a changed value where it does not are dropped, the others
count. So a question asked again with other values is found, and a text that merely has
the same shape is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise
from .line_dedup import _bind

WINDOW = 8
#: An item with fewer tokens is reported only where it fills whole lines or sentences.
MIN_TOKENS = 5
#: Share of an item's tokens that one document must hold.
MIN_COVER = 0.5
#: Share of the held tokens that must be the item's own: with nearly all values changed, nothing is left that is the item's.
MIN_OWN = 0.25
#: Tokens of texts that are worked on together; one longer text is taken alone.
CHUNK_TOKENS = 1 << 18

UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t oz lb ml l gal s sec min h hr ms hz khz mhz ghz b kb mb gb tb "
    "w kw mw v a j kj cal kcal pa bar k c f mph kmh percent dollars dollar euros euro pounds pound cents usd eur gbp "
    "meters meter metres metre kilometers kilometres miles mile inches inch feet foot grams gram kilograms liters "
    "litres seconds second minutes minute hours hour days day weeks week months month years year degrees degree % $ € £".split()
)
_NUMBER = re.compile(r"[$€£+-]?\d[\d.,:/]*(?:\D{0,4})")
_EDGES = "\"'`.,;:!?()[]{}<>«»„“”‚‘’*_~|#&%$@^+=/\\-–—…¿¡"
#: Tokens beside a number; at the start of a line or between words they are bullets and dashes.
SIGNS = frozenset("+ - * / = < > ^ × ÷ ± ≤ ≥ ≠ − == <= >= != **".split())
_WORD, _NAME, _NUM, _UNIT, _NONE, _SIGN = range(6)


class Template:
    """Template codes of texts. Words are looked up in a table that forgets when it is full."""

    def __init__(self, most: int = 500_000):
        self.codes, self.kinds, self.end = np.empty(most, np.uint64), np.empty(most, np.int8), np.empty(most, bool)
        self.index: dict[str, int] = {}

    def _learn(self, raw: str) -> int:
        import hashlib

        core = raw.strip(_EDGES) or (raw if raw in UNITS or raw in SIGNS else "")
        low = core.lower()
        if not core:
            kind = _NONE
        elif raw in SIGNS:
            kind = _SIGN
        elif _NUMBER.fullmatch(raw.strip("\"'`()[]{};!?,")) or core[0].isdigit():
            kind = _NUM
        elif low in UNITS:
            kind = _UNIT
        else:
            # Text in capitals is plain text in another case.
            kind = _NAME if core[0].isupper() and core[1:] != core[1:].upper() else _WORD
        digest = int.from_bytes(hashlib.blake2b(low.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        i = self.index[raw] = len(self.index)
        self.codes[i], self.kinds[i] = digest, kind
        self.end[i] = raw.rstrip("\"'`)]}»”’*_")[-1:] in (".", "!", "?", ":")
        return i

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template hashes, the hash of each token's own text, and which tokens are slots."""
        t = self.tokens([text])
        return t.shown[0], t.own, t.slots[0]

    def tokens(self, texts: list[str]) -> Tokens:
        """The tokens of all texts, one behind the other."""
        raw: list[str] = []
        line_sizes, text_sizes = [], []
        for text in texts:
            before = len(raw)
            for line in text.splitlines():
                words = line.split()
                raw += words
                line_sizes.append(len(words))
            text_sizes.append(len(raw) - before)
        if len(self.index) + len(raw) > len(self.codes):
            self.__init__(max(len(self.codes), 2 * len(raw)))
        get, learn = self.index.get, self._learn
        at = np.array([i if (i := get(w)) is not None else learn(w) for w in raw], np.int64)
        raw_text = np.repeat(np.arange(len(texts)), text_sizes)
        breaks = np.zeros(len(at) + 1, np.int64)
        breaks[np.cumsum([0, *line_sizes])] = 1
        kinds = self.kinds[at]
        number = np.concatenate([[False], kinds == _NUM, [False]])
        beside = (number[:-2] & ~breaks[:-1].astype(bool)) | number[2:]
        here = np.flatnonzero((kinds != _NONE) & ((kinds != _SIGN) | (beside & (breaks[:-1] == 0))))
        kinds, codes, text_of = kinds[here], self.codes[at][here], raw_text[here]
        # Marks count from behind the token before, or from the start of the text.
        text_starts = (np.cumsum(text_sizes) - text_sizes)[text_of] if len(here) else here
        since = np.maximum(np.concatenate([[-1], here[:-1]])[: len(here)], text_starts - 1)

        def first(marks: np.ndarray) -> np.ndarray:
            # Dashes and bullets pass the start on to the token behind them.
            count = np.concatenate([[0], np.cumsum(marks)])
            return count[here + 1] - count[since + 1] > 0

        stops = np.zeros(len(at) + 1, np.int64)
        stops[1:] = self.end[at]
        stops[(np.cumsum(text_sizes) - text_sizes)] = 0  # what ends the text before
        stop, line = first(stops), first(breaks)
        starts = stop | line
        new = np.concatenate([[True], text_of[1:] != text_of[:-1]])[: len(here)]
        # A unit is a slot only behind a number: "a day" is plain words.
        lone = (kinds == _UNIT) & (new | ~np.concatenate([[False], kinds[:-1] == _NUM])[: len(kinds)])
        shown, slots = [], []
        for plain in (starts, stop):  # a capital after a full stop makes no name
            kind = np.where((kinds == _NAME) & plain, _WORD, kinds)
            slot = (kind != _WORD) & (kind != _SIGN) & ~lone
            shown.append(np.where(slot, kind.astype(np.uint64), codes)), slots.append(slot)
        sizes = np.bincount(text_of, minlength=len(texts))
        return Tokens(text_of, np.arange(len(here)) - (np.cumsum(sizes) - sizes)[text_of], sizes, codes, shown, slots, starts, np.append(starts[1:], True)[: len(starts)])


@dataclass
class Tokens:
    """Text and place of each token, tokens of each text, and for each token its own hash, template hashes
    and slots in two views, and whether it starts or ends a line or sentence.

    A capital at the start of the text or of a line makes no name in the first view
    and a name in the second: a heading or a wrapped line may lie before it.
    """

    text: np.ndarray
    place: np.ndarray
    sizes: np.ndarray
    own: np.ndarray
    shown: list[np.ndarray]
    slots: list[np.ndarray]
    starts: np.ndarray
    ends: np.ndarray


def _window_hashes(codes: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows that start at the places ``at``, or of all."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n if at is None else len(at), width, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            total = (total ^ (codes[j : j + n] if at is None else codes[at + j])) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return total


def _within(marked: np.ndarray, width: int) -> np.ndarray:
    """How many marked tokens each window has."""
    count = np.concatenate([[0], np.cumsum(marked)])
    return count[width:] - count[:-width]


def _found(hashes: np.ndarray, at: np.ndarray, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows that the benchmark may have; all without a map."""
    if bits is None:
        return at, hashes
    place = (hashes & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return at[hit], hashes[hit]


def _text_windows(t: Tokens, width: int, allowed: np.ndarray, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Places, hashes and slots (none for windows of own text) of the windows that start at ``allowed`` places.

    All windows of own text; of each view the windows with slots and a word. A
    window without slots has one hash for all, and one of slots alone would match any values.
    """
    n = len(allowed)
    whole = _window_hashes(t.own, width)
    at = np.flatnonzero(allowed)
    yield *_found(whole if len(at) == n else whole[at], at, bits), None
    for view, (shown, slots) in enumerate(zip(t.shown, t.slots, strict=True)):
        count = _within(slots, width)
        new = allowed & (count > 0) & (count < width)
        if view:  # the views differ at some starts of lines
            new &= _within(slots != t.slots[0], width) > 0
        at = np.flatnonzero(new)
        if len(at):
            hashes = _window_hashes(shown, width, at) if len(at) < n // 4 else _window_hashes(shown, width)[at]
            yield *_found(hashes, at, bits), slots


def _window_rows(template: Template, texts: list[str], widths: tuple[int, ...], filters: dict | None) -> dict[str, list]:
    """Windows of texts as columns; without filters those of benchmark items, each of one width, with their classes."""
    bench = filters is None
    t = template.tokens(texts)
    own_widths = np.clip(t.sizes, 1, WINDOW)
    out: dict[str, list] = {k: [] for k in _WINDOW_COLUMNS if bench or k not in _ITEM_COLUMNS} | {"row": []}
    kind_of, number_of = ([], {}) if not bench else _kinds(t)
    for width in np.unique(own_widths[t.sizes > 0]).tolist() if bench else widths:
        n = len(t.own) - width + 1
        if n <= 0:
            continue
        allowed = t.text[:n] == t.text[width - 1 :]
        if bench:
            allowed &= own_widths[t.text[:n]] == width
        elif width < MIN_TOKENS:
            allowed &= t.starts[:n] & t.ends[width - 1 :]
        for at, hashes, slots in _text_windows(t, width, allowed, None if bench else filters[width]):
            marked = slots if slots is not None or not bench else t.slots[1]
            for k, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                # The values of a document's window of own text are the item's.
                inside = np.flatnonzero(marked[k : k + width]) + k if marked is not None else np.zeros(0, np.int64)
                i = int(t.text[k])
                values = t.own[inside].view(np.int64).tolist()
                out["row"].append(i), out["width"].append(width), out["place"].append(int(t.place[k])), out["hash"].append(h), out["slots"].append(values)
                if bench:
                    out["tokens"].append(int(t.sizes[i])), out["kind"].append(kind_of[i]), out["at"].append(t.place[inside].tolist())
                    out["groups"].append([number_of[i, v] for v in values]), out["is_own"].append(slots is None)
    return out


def _kinds(t: Tokens) -> tuple[list[int], dict[tuple[int, int], int]]:
    """The class of each text, and a number for each of its values: texts of one class differ in their values alone."""
    import hashlib

    kinds, numbers = [], {}
    ends = np.cumsum(t.sizes)
    for i, (start, end) in enumerate(zip((ends - t.sizes).tolist(), ends.tolist(), strict=True)):
        values = t.own[start:end][t.slots[1][start:end]].view(np.int64).tolist()
        for number, v in enumerate(dict.fromkeys(values)):
            numbers[i, v] = number
        data = t.shown[0][start:end].tobytes() + np.array([numbers[i, v] for v in values], np.int64).tobytes()
        kinds.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True))
    return kinds, numbers


#: Columns of windows, those of ``_ITEM_COLUMNS`` for the benchmark alone.
_WINDOW_COLUMNS = {
    "width": "int", "place": "int", "hash": "bigint", "slots": "array<bigint>",
    "tokens": "int", "kind": "bigint", "at": "array<int>", "groups": "array<int>", "is_own": "boolean",
}
_ITEM_COLUMNS = ("tokens", "kind", "at", "groups", "is_own")


def _windows(texts: DataFrame, keys: list[str], widths: tuple[int, ...] = (), filters: dict | None = None) -> DataFrame:
    """Template windows of a frame with the columns ``keys`` and ``text``; ``filters`` drops those the benchmark can't have."""
    from pyspark.sql.types import StructType

    columns = [c for c in _WINDOW_COLUMNS if filters is None or c not in _ITEM_COLUMNS]
    schema = StructType([*(texts.schema[k] for k in keys), *StructType.fromDDL(", ".join(f"{c} {_WINDOW_COLUMNS[c]}" for c in columns))])
    types = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template()
        for batch in batches:
            names = batch.schema.names
            column = batch.column(names.index("text"))
            held, start, size = [], 0, 0
            for i in range(batch.num_rows):
                held.append(column[i].as_py() or "")
                size += len(held[-1])
                if size >= 6 * CHUNK_TOKENS or i == batch.num_rows - 1:
                    made = _window_rows(template, held, widths, filters)
                    rows = pa.array(made["row"], pa.int64())
                    arrays = [batch.column(names.index(k)).slice(start, len(held)).take(rows) for k in keys]
                    arrays += [pa.array(made[c], types[_WINDOW_COLUMNS[c]]) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *columns])
                    held, start, size = [], i + 1, 0

    return texts.select(*keys, "text").mapInArrow(make, schema)


def _bitmaps(bench: DataFrame) -> dict[int, np.ndarray]:
    """One bit per window hash of the benchmark, by width; at most 16 MB each.

    Each task sets the bits of its own windows. A benchmark that fills the map lets more
    windows through to the join; it never loses one.
    """
    counts = {r["width"]: r["n"] for r in bench.groupBy("width").agg(F.count("*").alias("n")).collect()}  # at most WINDOW rows
    size = {w: 1 << min(27, max(16, (64 * n).bit_length())) for w, n in counts.items()}

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = {w: np.zeros(n // 8, np.uint8) for w, n in size.items()}
        for batch in batches:
            width, hashes = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for w in np.unique(width):
                place = (hashes[width == w].view(np.uint64) & np.uint64(size[w] - 1)).astype(np.int64)
                np.bitwise_or.at(maps[w], place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([m.tobytes() for m in maps.values()])], names=["width", "bits"])

    maps = {w: np.zeros(n // 8, np.uint8) for w, n in size.items()}
    # The benchmark, not the corpus: few tasks, each sending the maps once.
    for row in bench.select("width", "hash").coalesce(8).mapInArrow(bits, "width int, bits binary").toLocalIterator():
        maps[row["width"]] |= np.frombuffer(row["bits"], np.uint8)
    return maps


def _judged(places: Column, fills: Column, width: Column) -> Column:
    """Of one alignment: tokens in windows that count (``covered``), changed values there (``changed``), and conflicting values (``broken``)."""

    def several(values: Column) -> Column:  # values of the class that stand for several values of the document
        return F.transform(F.filter(values, lambda x, i: (i > 0) & (F.get(values, i - 1)["g"] == x["g"])), lambda x: x["g"])

    def broken(all_fills: Column) -> Column:
        values = F.array_sort(F.array_distinct(F.transform(all_fills, lambda f: F.struct(f["g"].alias("g"), f["b"].alias("b")))))
        many = _bind(values, several)
        wrong = _bind(many, lambda m: F.filter(all_fills, lambda f: ~f["own"] & F.array_contains(m, f["g"])))
        return F.array_distinct(F.transform(wrong, lambda f: f["p"]))

    def judge(s: Column) -> Column:
        kept = F.filter(s["places"], lambda p: ~F.exists(s["broken"], lambda x: (x >= p) & (x < p + s["width"])))
        covered = F.array_distinct(F.flatten(F.transform(kept, lambda p: F.sequence(p, p + s["width"] - 1))))
        own = F.transform(F.filter(s["fills"], lambda f: f["own"]), lambda f: f["p"])
        changed = F.array_except(F.transform(F.filter(s["fills"], lambda f: ~f["own"]), lambda f: f["p"]), own)
        return F.struct(covered.alias("covered"), F.array_intersect(changed, covered).alias("changed"), s["broken"].alias("broken"))

    return _bind(F.struct(places.alias("places"), _bind(fills, broken).alias("broken"), width.alias("width"), fills.alias("fills")), judge)


def template_classes(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, kind`` of all items with tokens: items of one ``kind`` differ in their numbers, names and units alone."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    return _windows(items, ["item_id"]).select("item_id", "kind").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, item_id, covered, verbatim`` for each document that holds an item.

    ``covered`` is the share of the item's tokens in matching windows, less the share of
    those that only conflicting windows hold; ``verbatim`` says that all slots have the
    item's own values. Of a class of items with the same words the one with the fewest
    fellows in a window of own text is named, else the one with the smallest id; ``template_classes`` lists
    the others. Null or empty texts on either side match nothing. Items under
    ``WINDOW`` tokens are one window of their own length; under ``MIN_TOKENS`` they must
    fill whole lines or sentences. Texts are read whole. Repeated items or documents give one row
    (``text_key`` tells apart texts with the same id). A null id is an id like others.
    Empty tables give no rows. Other columns are not read.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    window = ["kind", "tokens", "width", "place", "hash", "is_own"]
    least = F.min(F.struct(F.col("item_id").isNull().alias("none"), "item_id", "at", "groups", "slots"))
    bench = materialise(_windows(items, ["item_id"]).groupBy(*window).agg(least.alias("first"), F.count("*").alias("fellows")))
    maps = _bitmaps(bench)
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    found = _windows(source, ["doc_id", "text_key"], tuple(sorted(maps)), maps)
    bench = bench.select(
        "kind", "tokens", "width", "hash", "is_own", F.col("place").alias("item_place"), "fellows", F.col("first.none").alias("none"), F.col("first.item_id").alias("item_id"),
        F.col("first.at").alias("item_at"), F.col("first.groups").alias("groups"), F.col("first.slots").alias("item_slots"),
    )
    # Windows of own text come without slots from the document: their values are the item's.
    filled = F.transform(
        F.arrays_zip(F.col("item_at").alias("p"), F.col("groups").alias("g"), F.col("item_slots").alias("a"), F.col("slots").alias("b")),
        lambda f: F.struct(f["p"].alias("p"), f["g"].alias("g"), F.coalesce(f["b"], f["a"]).alias("b"), F.coalesce(f["a"] == f["b"], F.lit(True)).alias("own")),
    )
    # Copies of a window at one alignment are one match.
    pairs = found.join(bench, ["width", "hash"]).select(
        "doc_id", "text_key", "kind", "tokens", "width", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), filled.alias("fills"),
        F.struct((~F.col("is_own") | (F.size("groups") == 0)).alias("shared"), "fellows", "none", "item_id").alias("name"),
    )
    aligned = pairs.groupBy("doc_id", "text_key", "kind", "tokens", "width", "shift").agg(
        F.collect_set("item_place").alias("places"), F.array_distinct(F.flatten(F.collect_set("fills"))).alias("fills"), F.min("name").alias("name")
    )
    judged = aligned.select(
        "doc_id", "text_key", "kind", "tokens", "name", _judged(F.col("places"), F.col("fills"), F.col("width")).alias("judged"),
    ).select("doc_id", "text_key", "kind", "tokens", "name", "judged.*").filter(F.size("covered") > 0)
    together = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    by_kind = judged.groupBy("doc_id", "text_key", "kind", "tokens").agg(
        together(F.col("covered")).alias("all"), together(F.when(F.size("broken") == 0, F.col("covered"))).alias("clean"),
        together(F.col("broken")).alias("broken"), F.array_distinct(F.flatten(F.collect_set(F.array_except("covered", "changed")))).alias("same"),
        F.min((F.size("changed") == 0) & (F.size("broken") == 0)).alias("verbatim"), F.min("name").alias("name"),
    )
    # A conflict elsewhere takes nothing from alignments without any.
    n = F.greatest(F.size("clean"), F.size("all") - F.size(F.array_except("broken", "all")))
    covered = n / F.col("tokens")
    # One item id with several texts counts by its best text.
    enough = (covered >= MIN_COVER) & (F.size("same") >= MIN_OWN * F.size("all"))
    return by_kind.filter(enough).groupBy("doc_id", "text_key", F.col("name.item_id").alias("item_id")).agg(
        F.max(covered).alias("covered"), F.max("verbatim").alias("verbatim")
    )


def _flagged(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    hits = matches(docs, benchmark, id_col, text_col)
    return materialise(hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("covered").alias("covered"), F.max("verbatim").alias("verbatim")
    ).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "item_ids", "covered", "verbatim"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, contaminated, item_ids, covered, verbatim`` for each row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"))
    on = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    return rows.join(_flagged(docs, benchmark, id_col, text_col), on, "left").select(
        "doc_id",
        F.col("hit_key").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("covered", F.lit(0.0)).alias("covered"),
        F.coalesce("verbatim", F.lit(False)).alias("verbatim"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, without the rows that hold a benchmark item."""
    hits = _flagged(docs, benchmark, id_col, text_col).select("hit_id", "hit_key")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("d"), F.xxhash64(text_col).alias("k"))
    kept = rows.join(hits, F.col("d").eqNullSafe(F.col("hit_id")) & (F.col("k") == F.col("hit_key")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the benchmark items that they hold."""
    return report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
