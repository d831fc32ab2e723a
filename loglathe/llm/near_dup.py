"""Near duplicates by b-bit MinHash.

Each document gets 128 minima over its word shingles. Bands of four minima name the
buckets in which candidates meet; of each minimum only the low four bits are kept, as
bit planes, so that the similarity of a pair is estimated by counting equal positions and
correcting for chance. What passes is confirmed on the full shingle sets.

Equal sets are one node. In a bucket every node is first paired with one pivot: in a few
bands for all nodes, which joins most of a large group, then in the others for what is not
joined yet. Only where nodes of different components still meet are the
remaining pairs looked at, in blocks of bounded size, and each pair in one of its buckets;
the nodes of a bucket's largest component meet only the others, not one another. Blocks
compare bit planes first; shingle sets are sent for the nodes that pass. No link is lost,
and pairs inside a component are never listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialise

HASHES, BAND, BITS = 128, 4, 4
BANDS = HASHES // BAND  # a pair at similarity 0.8 shares a bucket but for 5 in 10^8
SIMILAR = 80  # per cent
#: Six standard deviations of the estimate below 0.8: the filter before the exact test.
LEAST_ESTIMATE = 0.58
#: Bands whose pivots come first.
FIRST_BANDS = 4
#: Nodes outside the largest component that a block of a bucket holds, bytes of their shingle
#: sets, and nodes that are passed by a block in one group.
BLOCK, BLOCK_BYTES, SLICE = 1024, 32 << 20, 1 << 16

_SPLIT = np.random.default_rng(20)
_A = _SPLIT.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SPLIT.integers(0, 2**63, HASHES, dtype=np.uint64)


class Shingles:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""

    def __init__(self, words: int, most: int = 400_000):
        self.words, self.most, self.known = words, most, {}

    def of(self, text: str | None) -> np.ndarray:
        # bytes: lower() is for A-Z only and split() for ASCII white space only
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) + len(words) > max(self.most, 2 * len(words)):
            self.known.clear()
        get, known = self.known.get, self.known
        hashes = []
        for word in words:
            h = get(word)
            if h is None:
                h = known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            hashes.append(h)
        codes, n = np.array(hashes, np.uint64), min(self.words, len(words))
        total = np.full(len(codes) - n + 1, n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                total = (total ^ codes[j : len(codes) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(32)
        return np.unique(total)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(sets), HASHES), np.uint32)
    with np.errstate(over="ignore"):
        for i, s in enumerate(sets):
            least = np.full(HASHES, 2**32 - 1, np.uint64)
            for at in range(0, len(s), 4096):
                np.minimum(least, ((s[at : at + 4096, None] * _A + _B) >> np.uint64(32)).min(axis=0), out=least)
            out[i] = least
    return out


def _planes(minima: np.ndarray) -> np.ndarray:
    """Low bits of the minima as bit planes: ``BITS`` times two words of 64 positions."""
    bits = (minima[:, None, :] >> np.arange(BITS, dtype=np.uint32)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").reshape(len(minima), -1).view(np.int64)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(minima), 1))
    parts = minima.reshape(-1, BANDS, BAND).astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(BAND):
            keys = (keys ^ parts[:, :, j]) * np.uint64(0xC2B2AE3D27D4EB4F)
            keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1)))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``doc_id, text_key, n, node, planes, bands`` of each row; without words the last three are null."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sets = [shingles.of(t) for t in part.column(2).to_pylist()]
                minima = _minima(sets)
                n = np.array([len(s) for s in sets], np.int64)
                node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(node, pa.binary()), _lists(_planes(minima)), _lists(_band_keys(minima))],
                    names=["doc_id", "text_key", "n", "node", "planes", "bands"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sign, f"doc_id {id_type}, text_key bigint, n bigint, node binary, planes array<bigint>, bands array<bigint>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two plane arrays: equal positions, less those equal by chance."""
    half = len(range(0, HASHES, 64))
    differing = None
    for w in range(half):
        mixed = None
        for plane in range(BITS):
            x = a[plane * half + w].bitwiseXOR(b[plane * half + w])
            mixed = x if mixed is None else mixed.bitwiseOR(x)
        count = F.bit_count(mixed)
        differing = count if differing is None else differing + count
    chance = 2.0**-BITS
    return ((1 - differing / HASHES) - chance) / (1 - chance)


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``node, members`` (the packed shingle set) for the nodes of ``wanted``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            packed = [shingles.of(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "members"])

    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text"))
    found = rows.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key")))
    return found.select("node", "text").mapInArrow(make, "node binary, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(test, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``a, b``; the root is the smallest node reached.

    Every node hooks to its smallest neighbour if that is smaller than itself. These trees are
    followed to their roots, each becomes one node, and the edges left between them go
    on. At least half of the nodes with edges vanish each time. Each step is a written table.
    """
    left = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        tree = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
        while True:
            up = tree.select(F.col("node").alias("at"), F.col("root").alias("further"))
            climbed = materialise(tree.join(up, tree["root"] == up["at"]).select("node", F.col("root").alias("old"), F.col("further").alias("root")))
            tree = climbed.select("node", "root")
            if climbed.filter("old <> root").isEmpty():
                break
        ends = left.join(tree.toDF("a", "root_a"), "a").join(tree.toDF("b", "root_b"), "b")
        left = materialise(ends.filter("root_a <> root_b").select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct())
        labels = tree if labels is None else materialise(joined_labels(labels, tree))
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels


def joined_labels(labels: DataFrame, above: DataFrame) -> DataFrame:
    """Labels of nodes, and labels of their roots and of nodes without label, as one."""
    top = above.select(F.col("node").alias("at"), F.col("root").alias("top"))
    moved = labels.join(top, labels["root"] == top["at"], "left").select("node", F.coalesce("top", "root").alias("root"))
    new = top.join(labels.select("node"), top["at"] == F.col("node"), "left_anti")
    return moved.union(new.select("at", "top"))


class _Held:
    """The nodes of a block that others are compared with."""

    def __init__(self):
        self.size, self.known, self.rows = 0, {}, []
        self.planes, self.bands = np.empty((64, BITS * HASHES // 64), np.int64), np.empty((64, BANDS), np.int64)
        self.n, self.roots = np.empty(64, np.int64), np.empty(64, np.int64)

    def number(self, root: bytes) -> int:
        return self.known.setdefault(root, len(self.known))

    def add(self, planes: np.ndarray, bands: np.ndarray, n: int, root: int, row: tuple) -> None:
        if self.size == len(self.n):
            self.planes, self.bands, self.n, self.roots = (np.concatenate([x, np.empty_like(x)]) for x in (self.planes, self.bands, self.n, self.roots))
        self.planes[self.size], self.bands[self.size], self.n[self.size], self.roots[self.size] = planes, bands, n, root
        self.rows.append(row)
        self.size += 1

    def near(self, planes: np.ndarray, bands: np.ndarray, n: int, root: int, band: int) -> np.ndarray:
        """Held nodes of other components that may be similar, and share no bucket of an earlier band."""
        sizes = self.n[: self.size]
        y = np.flatnonzero((self.roots[: self.size] != root) & (100 * np.minimum(sizes, n) >= SIMILAR * np.maximum(sizes, n)))
        if len(y):
            y = y[(self.bands[y] == bands).argmax(axis=1) == band]
        if len(y):
            mixed = np.bitwise_or.reduce((self.planes[y] ^ planes).reshape(len(y), BITS, HASHES // 64), axis=1)
            # unsigned: of a signed number the bits of its absolute value would be counted
            equal = 1 - np.bitwise_count(mixed.view(np.uint64)).sum(axis=1) / HASHES
            y = y[(equal - 2.0**-BITS) / (1 - 2.0**-BITS) >= LEAST_ESTIMATE]
        return y

    def merge(self, root: int, other: int) -> None:
        self.roots[: self.size][self.roots[: self.size] == other] = root
        for name, number in self.known.items():
            if number == other:
                self.known[name] = root


_GROUP = ["bucket", "band", "block", "slice"]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, _Held, np.ndarray, tuple]]:
    """Rows sorted by group and role with what is near them: group, whether they are held from now on, what is held, near ones, row."""
    current, held = None, _Held()
    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keys = zip(*(column[k].to_pylist() for k in [*_GROUP, "role"]), strict=True)
        planes, bands = (column[k].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for k in ("planes", "bands"))
        rest = zip(*(column[k].to_pylist() for k in ("node", "root", "n")), column["members"].to_pylist() if "members" in column else [None] * batch.num_rows, strict=True)
        for i, ((*group, role), (node, root, n, members)) in enumerate(zip(keys, rest, strict=True)):
            group = tuple(group)
            if group != current:
                current, held = group, _Held()
            number = held.number(root)
            # Held nodes are in every slice, and meet one another in the first.
            near = held.near(planes[i], bands[i], n, number, group[1]) if held.size and (role or not group[3]) else np.zeros(0, np.int64)
            yield group, not role, held, near, (node, root, members)
            if not role:
                held.add(planes[i], bands[i], n, held.number(root), (node, root, members))


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each group that have a node whose estimate passes."""
    names = [*_GROUP, "role", "node", "root"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    out: list[tuple] = []
    current, seen = None, set()
    for group, is_held, held, near, (node, root, _) in _compared(batches):
        if group != current:
            current, seen = group, set()
        if len(near):
            out.append((*group, int(not is_held), node, root))
            if is_held:
                seen.add(held.size)
            for k in near.tolist():
                if k not in seen:
                    seen.add(k)
                    out.append((*group, 0, *held.rows[k][:2]))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components by full sets; what is linked inside a group is one component from then on."""
    a: list[bytes] = []
    b: list[bytes] = []
    for _, _, held, near, (_, root, members) in _compared(batches):
        mine = np.frombuffer(members, np.uint64)
        for k in near.tolist():
            number = held.number(root)
            if held.roots[k] == number:
                continue
            theirs = np.frombuffer(held.rows[k][2], np.uint64)
            at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            common = int((mine[at] == theirs).sum())
            if 100 * common >= SIMILAR * (len(mine) + len(theirs) - common):
                a.append(root), b.append(held.rows[k][1])
                held.merge(number, int(held.roots[k]))
        if len(a) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _dealt(labelled: DataFrame) -> DataFrame:
    """The nodes of buckets where several components meet, by group and role (0 held, 1 passing).

    A bucket's nodes outside its largest component are dealt to blocks by hash. A block is
    held; the other nodes of the bucket pass it, in slices. A row is copied for each block it passes and a held
    one for each slice: with few nodes outside, once.
    """
    rows = labelled.filter("node <> pivot")  # pivots have been compared
    sizes = rows.groupBy("bucket", "band", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    largest = F.max(F.struct("c", "s", "root"))
    open_ones = sizes.groupBy("bucket", "band").agg(largest.alias("main"), F.sum("c").alias("c"), F.sum("s").alias("s")).filter(F.col("c") > F.col("main.c"))
    others, held_bytes = F.col("c") - F.col("main.c"), 8 * (F.col("s") - F.col("main.s"))
    open_ones = open_ones.select(
        F.col("bucket").alias("open"), F.col("band").alias("open_band"), F.col("main.root").alias("main"),
        F.greatest(F.ceil(others / BLOCK), F.ceil(held_bytes / BLOCK_BYTES)).cast("int").alias("blocks"), F.ceil(F.col("c") / SLICE).cast("int").alias("slices"),
    )
    met = rows.join(open_ones, (F.col("bucket") == F.col("open")) & (F.col("band") == F.col("open_band")))
    met = met.withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("part", F.pmod(F.xxhash64("node", F.lit("slice")), "slices").cast("int"))
    passed = lambda last: F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(j.alias("block"), F.col("part").alias("slice"), F.lit(1).alias("role")))
    held = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda j: F.struct(F.col("mine").alias("block"), j.alias("slice"), F.lit(0).alias("role")))
    places = F.when(F.col("root") == F.col("main"), passed(F.col("blocks") - 1)).when(F.col("mine") == 0, held).otherwise(F.concat(held, passed(F.col("mine") - 1)))
    return met.select("bucket", "band", "node", "root", F.explode(places).alias("p")).select("bucket", "band", "p.block", "p.slice", "p.role", "node", "root")


def _remaining_links(labelled: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between components from the buckets where nodes of several ones meet."""

    def in_groups(df: DataFrame, with_sets: bool) -> DataFrame:
        full = df.join(nodes.select("node", "n", "planes", "bands"), "node")
        full = full.join(sets, "node") if with_sets else full
        columns = [*_GROUP, "role", "node", "root", "n", "planes", "bands", *(["members"] if with_sets else [])]
        return full.select(*columns).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "role")

    survivors = materialise(in_groups(_dealt(labelled), False).mapInArrow(_passing, "bucket bigint, band int, block int, slice int, role int, node binary, root binary"))
    return in_groups(survivors, True).mapInArrow(_links, "a binary, b binary")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``doc_id, text_key, n, root, component_id`` of each row; the last two are null without words."""
    signed = materialise(signatures(docs, id_col, text_col, words))
    nodes = signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("doc_id", "text_key")).alias("row"),
        F.first("n").alias("n"), F.first("planes").alias("planes"), F.first("bands").alias("bands"),
    )
    nodes = materialise(nodes.select("node", "least_id", F.col("row.doc_id").alias("doc_id"), F.col("row.text_key").alias("text_key"), "n", "planes", "bands"))

    # Buckets with several nodes, and the pivot of each: one order in the first bands and one in the others,
    # so that the nodes of a large group mostly share theirs.
    rows = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    order = F.struct(F.xxhash64("node", F.col("band") < FIRST_BANDS).alias("o"), F.col("node").alias("node"))
    shared = rows.groupBy("bucket", "band").agg(F.count("*").alias("rows"), F.min(order).alias("pivot")).filter("rows > 1")
    shared = shared.select(F.col("bucket").alias("shared"), F.col("band").alias("shared_band"), F.col("pivot.node").alias("pivot"))
    met = materialise(rows.join(shared, (F.col("bucket") == F.col("shared")) & (F.col("band") == F.col("shared_band"))).select("bucket", "band", "node", "n", "pivot"))
    wanted = met.select("node").distinct().join(nodes.select("node", "doc_id", "text_key"), "node")
    sets = materialise(_sets(docs, wanted, id_col, text_col, words).dropDuplicates(["node"]))
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("planes").alias(f"planes_{x}"))

    def linked(pairs: DataFrame) -> DataFrame:
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(
            (100 * F.least("n_a", "n_b") >= SIMILAR * F.greatest("n_a", "n_b")) & (estimate(F.col("planes_a"), F.col("planes_b")) >= LEAST_ESTIMATE)
        ).select("a", "b")
        return materialise(_confirmed(near, sets))

    pairs = met.filter(F.col("node") != F.col("pivot")).select("band", F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    roots = components(linked(pairs.filter(F.col("band") < FIRST_BANDS).select("a", "b").distinct()))

    def with_roots(df: DataFrame) -> DataFrame:
        label = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
        both = df.join(label("a"), "a", "left").join(label("b"), "b", "left")
        return both.select("a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b"))

    apart = materialise(with_roots(pairs.filter(F.col("band") >= FIRST_BANDS).select("a", "b").distinct()).filter("root_a <> root_b"))
    more = linked(apart.select("a", "b")).join(apart, ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = materialise(joined_labels(roots, components(more)))

    labelled = materialise(met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    roots = joined_labels(roots, components(materialise(_remaining_links(labelled, nodes, sets))))

    ids = nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = ids.join(by_root, "root").select("node", "root", "component_id")
    return signed.join(of_node, "node", "left").select("doc_id", "text_key", "n", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for each row of ``docs``.

    Words are split at ASCII white space, A-Z lower-cased; a text with fewer words than
    ``words`` is one shingle. Null, empty and blank texts have no shingle and are linked
    with nothing: ``component_id`` is their own id. Other rows are linked at similarity 0.8 or more.
    ``component_id`` is the smallest id in reach (null ids count only where there is no
    other), ``kept`` marks the rows with that id. Rows that repeat an id are told apart by
    ``text_key``, a hash of the text. Texts are read whole, each in one task; an empty table
    gives no rows. Other columns are not read.
    """
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _grouped(docs, id_col, text_col, words).select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """``docs`` with its columns and one row of each group; rows without words all stay.

    The smallest id stays (a null id only where there is no other), of rows with that id the one
    with the smallest hash of its text, and one of the rows that repeat both, by a hash of their columns.
    """
    rows = _grouped(docs, id_col, text_col, words).filter(F.col("root").isNotNull())
    texts = rows.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    texts = texts.select("root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key").alias("t"), "copies")
    first = texts.groupBy(F.col("root").alias("of")).agg(F.min("t").alias("first"))
    marked = texts.join(first, texts["root"] == first["of"]).select(
        F.col("t.doc_id").alias("mark_id"), F.col("t.text_key").alias("mark_key"), (F.col("t") != F.col("first")).alias("gone"), "copies")
    marks = materialise(marked.filter("gone OR copies > 1").distinct())
    tagged = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("d"), F.xxhash64(text_col).alias("k"))
    on = F.col("d").eqNullSafe(F.col("mark_id")) & (F.col("k") == F.col("mark_key"))
    kept = tagged.join(marks.select("mark_id", "mark_key"), on, "left_anti").select("row")
    repeated = marks.filter("NOT gone")
    if not repeated.isEmpty():
        plain = [F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().startswith(("map", "array", "struct", "variant"))]
        hashed = docs.select(F.struct("*").alias("row"), F.xxhash64(*plain).alias("h"), F.col(id_col).alias("d"), F.xxhash64(text_col).alias("k"))
        chosen = hashed.join(repeated.select("mark_id", "mark_key"), on, "left_semi").groupBy("d", "k").agg(F.min_by("row", "h").alias("row"))
        kept = kept.union(chosen.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents, on shingles of two words."""
    return near_duplicates(load(spark, sf_dir, "documents"), words=2).select("doc_id", "n_shingles", "component_id", "kept")


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS r FROM sets
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
"""
