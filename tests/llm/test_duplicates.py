"""Exact copies, near copies and repeated lines against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from loglathe.llm import exact_dedup, line_dedup, near_dup
from loglathe.llm.catalog import QUERIES
from tests.conftest import SMALL

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def table(spark, name):
    return [r.asDict() for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]


# exact copies


def copies_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


def found_copies(df):
    return sorted((tuple(r) for r in exact_dedup.copies(df).collect()), key=repr)


def test_copies_equal_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found_copies(df) == copies_by_hand([(r.doc_id, r.text) for r in df.collect()])


def test_copies_of_odd_rows(odd_docs, no_docs):
    assert found_copies(odd_docs) == copies_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert found_copies(no_docs) == []


def test_group_over_many_partitions(spark, frame):
    """One text in most rows crosses partition edges and comes out as one group."""
    rows = [(i, "same  text" if i == 77 else "same text") for i in range(400)] + [(1000 + i, f"text {i % 50}") for i in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found_copies(frame(*rows).repartition(7))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == copies_by_hand(rows)


# near copies


def shingles(text, words):
    w = [x for x in BLANK.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def components_by_hand(rows, words):
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def found_components(df, words):
    rows = near_dup.near_duplicates(df, words=words).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_near_copies_equal_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found_components(df, 2) == components_by_hand([(r.doc_id, r.text) for r in df.collect()], 2)


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    assert found_components(odd_docs, 2) == components_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()], 2)
    assert found_components(no_docs, 2) == []


def test_no_link_is_lost_in_a_wide_group(frame, monkeypatch):
    """A group whose members are partly too far apart: pivots alone do not join it, the blocks do."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.choice([1, 3, 5, 6, 7, 8])):
            words[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    expected = components_by_hand(rows, 2)
    assert len({c for _, _, c in expected}) > 1
    assert found_components(frame(*rows), 2) == expected


def test_estimate_is_corrected_for_chance():
    import numpy as np

    draw = np.random.default_rng(1)
    both = draw.integers(0, 2**63, 700, dtype=np.uint64)
    sets = [np.unique(np.concatenate([both, draw.integers(0, 2**63, 300, dtype=np.uint64)])) for _ in range(2)]
    planes = near_dup._planes(near_dup._minima(sets))
    mixed = np.bitwise_or.reduce((planes[0] ^ planes[1]).reshape(near_dup.BITS, -1), axis=0)
    equal = 1 - np.bitwise_count(mixed.view(np.uint64)).sum() / near_dup.HASHES
    minima = near_dup._minima(sets)
    assert equal == ((minima[0] & 15) == (minima[1] & 15)).mean()
    assert abs((equal - 1 / 16) / (15 / 16) - 700 / 1300) < 0.15


def test_chain_has_one_root(spark):
    names = [f"{i:02d}".encode() for i in range(40)]
    edges = spark.createDataFrame(list(zip(names, names[1:])) + [(b"x", b"y")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in near_dup.components(edges).collect()}
    assert got == {**{n: b"00" for n in names}, b"x": b"x", b"y": b"x"}


def test_pipeline_form_keeps_columns(odd_docs):
    kept = near_dup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    # ids 6 and 7 are copies, and one row comes twice; everything else stays
    expected = sorted(str(r.doc_id) for r in odd_docs.collect() if r.doc_id != 7)
    expected.remove("4")
    assert sorted(str(r.doc_id) for r in kept.collect()) == expected


def test_one_row_of_each_group_stays(spark):
    """Also where the smallest id is repeated, by equal rows or other near copies, or all ids are null."""
    words = [f"w{i}" for i in range(60)]
    near = lambda i: " ".join([*words[:i], f"x{i}", *words[i + 1 :]])
    rows = [(1, near(0), "a"), (1, near(0), "b"), (1, near(59), "c"), (2, near(1), "d"), (None, near(2), "e")]
    rows += [(None, "null ids only " * 9, "f"), (None, "null ids only " * 9, "g"), (3, "", "h"), (4, "", "i"), (3, "", "h"), (5, None, "j")]
    kept = near_dup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, mark string")).collect()
    assert len([r for r in kept if (r.text or "").startswith(("w", "x"))]) == 1 and {r.doc_id for r in kept if (r.text or "").startswith(("w", "x"))} == {1}
    assert sorted(r.mark for r in kept if not r.text) == ["h", "h", "i", "j"]
    assert len([r for r in kept if (r.text or "").startswith("null")]) == 1


def test_few_outsiders_do_not_copy_a_large_component(spark, monkeypatch):
    """A bucket of 1,500 nodes of one component and three others: nodes pass the one block there is, once."""
    monkeypatch.setattr(near_dup, "BLOCK", 64)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets, roots = [], []
    for i in range(1503):
        own = base.copy()
        own[:4] = rng.integers(0, 2**63, 4, dtype=np.uint64)
        if i >= 1500:  # two that are linked with the others, and one that is not
            own[: 20 if i < 1502 else 300] = rng.integers(0, 2**63, 20 if i < 1502 else 300, dtype=np.uint64)
        sets.append(np.unique(own)), roots.append(b"main" if i < 1500 else f"o{i}".encode())
    minima = near_dup._minima(sets)
    planes, bands = near_dup._planes(minima).tolist(), near_dup._band_keys(minima)
    bands[:, 0] = 7  # all in one bucket of the first band
    name = lambda i: f"n{i:04d}".encode()
    nodes = spark.createDataFrame([(name(i), len(s), p, b) for i, (s, p, b) in enumerate(zip(sets, planes, bands.tolist()))], "node binary, n bigint, planes array<bigint>, bands array<bigint>")
    full = spark.createDataFrame([(name(i), s.tobytes()) for i, s in enumerate(sets)], "node binary, members binary")
    labelled = spark.createDataFrame([(7, 0, name(i), len(s), b"pivot", roots[i]) for i, s in enumerate(sets)], "bucket bigint, band int, node binary, n bigint, pivot binary, root binary")
    for slices in (near_dup.SLICE, 100):
        monkeypatch.setattr(near_dup, "SLICE", slices)
        dealt = near_dup._dealt(labelled)
        assert dealt.count() == 1500 + 3 * -(-1503 // slices)
        links = {frozenset((bytes(r.a), bytes(r.b))) for r in near_dup._remaining_links(labelled, nodes, full).collect()}
        pairs = {frozenset((roots[i], roots[j])) for i in range(1500, 1503) for j in range(1503) if roots[i] != roots[j]
                 and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
        assert links <= pairs and {b"main", b"o1500", b"o1501"} == set().union(*links)


# lines


def cut_by_hand(rows, width=3):
    """First occurrences by (id, place); rows that repeat id and text are one document."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, cut = {}, {}
    for i, text in docs:
        if text is None:
            continue
        lines = text.split("\n")
        filled = [(n, x.strip(" \t\n\x0b\x0c\r")) for n, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for k in range(len(filled) - width + 1):
            window = tuple(x for _, x in filled[k : k + width])
            if seen.setdefault(window, (i, k)) != (i, k):
                gone |= set(range(filled[k][0], filled[k + width - 1][0] + 1))
        cut[i, text] = "\n".join(x for n, x in enumerate(lines) if n not in gone)
    return sorted(((i, cut.get((i, t))) for i, t in rows), key=repr)


def found_cut(df):
    return sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()), key=repr)


def test_cut_equals_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found_cut(df) == cut_by_hand([(r.doc_id, r.text) for r in df.collect()])


def test_cut_of_overlaps_blanks_and_repeats(frame):
    rows = [
        (1, "a\nb\nc\nd\ne"), (2, "x\nb\n\n c \nd\ny"), (3, "c\nd\ne\nf\ng"), (4, "q\nq\nq\nq\nq"), (5, "a\nb"), (6, "a\nb\nc\nd\ne"),
        (6, "a\nb\nc\nd\ne"), (None, "f\ng\nh"), (7, "e\nf\ng\nh\nz"), (8, None), (9, ""), (10, "\n\n\n"),
    ]
    assert found_cut(frame(*rows)) == cut_by_hand(rows)
    spans = {r.row.doc_id: [tuple(s) for s in r.removed] for r in line_dedup.cut_repeats(frame(*rows)).collect()}
    assert spans[2] == [(1, 4)] and spans[6] == [(0, 4)] and spans[1] == []


def test_cut_of_odd_rows(odd_docs, no_docs):
    assert line_dedup.dedup_lines(odd_docs).columns == odd_docs.columns
    assert found_cut(odd_docs) == cut_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert found_cut(no_docs) == []


def test_line_plan_has_no_python(spark):
    df = QUERIES["op2_line_windows"](spark, SMALL)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
