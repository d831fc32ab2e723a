"""Runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from loglathe.llm import periodic
from tests.conftest import SMALL


def runs_by_hand(words, least=3):
    found = []
    for q in range(1, len(words) // 3 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i < len(words) - q and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + q
                part = words[start : start + length]
                if length >= max(least, 3 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((start, length, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_by_hand(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def row_by_hand(doc_id, text):
    words = planted_by_hand(doc_id, text)
    runs = runs_by_hand(words, 24)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def some_text(rng, size):
    """Words of few kinds, with stretches that repeat, also inside what repeats."""
    out = []
    while len(out) < size:
        kind = rng.random()
        if kind < 0.4 or not out:
            out += [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 40))]
        else:
            part = out[-rng.randint(1, min(len(out), 120)) :]
            out += part * rng.randint(2, 4) + part[: rng.randrange(len(part))]
    return out[:size]


@pytest.mark.parametrize("seed", range(12))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    texts = [some_text(rng, rng.choice([0, 1, 2, 30, 200, 700])) for _ in range(12)]
    got = [sorted(r, key=lambda r: (r[0], r[2])) for r in periodic.runs_of([np.array(t, np.int64) for t in texts])]
    assert got == [runs_by_hand(t) for t in texts]


def test_long_periods():
    rng = random.Random(5)
    base = [rng.randrange(10**6) for _ in range(3000)]
    inner = [1] * 700 + [2] + [1] * 299  # the period is full of runs of its own
    for part, times in ((base, 3), (base[:1024], 5), (inner, 4), ([0], 5000), (base[:7] * 30 + [9], 6)):
        text = [*base[:50], *(part * times), *part[: len(part) // 2], -0 + 7, *base[60:90]]
        got = periodic.runs_of([np.array(text, np.int64)])[0]
        assert (50 - (base[49] == part[-1]), len(part)) in {(s, p) for s, _, p in got}
        assert len(got) == len({(s, p) for s, _, p in got})


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    chosen = [d for d in docs if len((d.text or "").split()) < 1500]
    got = {r.doc_id: tuple(r) for r in periodic.op11_multiscale_minimizers(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in chosen:
        assert got[d.doc_id] == row_by_hand(d.doc_id, d.text)
    assert sum(r[1] > 0 for r in got.values()) >= len(docs) // 20


def test_odd_rows(spark, odd_docs, no_docs):
    rows = {(r.doc_id, r.n_words): r for r in periodic.periodic_runs(odd_docs).collect()}
    assert periodic.periodic_runs(odd_docs).count() == odd_docs.count()
    assert rows[1, 0].runs == [] and rows[1, 0].collapsed == "" and rows[None, 0].collapsed == ""
    assert [tuple(r) for r in rows[5, 60_000].runs] == [(0, 60_000, 1)] and rows[5, 60_000].collapsed == "word"
    assert rows[4, 1].collapsed == "one"
    assert periodic.periodic_runs(no_docs).count() == 0
    planted = periodic.with_planted_runs(odd_docs)
    assert sorted(planted.collect(), key=repr) == sorted(
        [(d.doc_id, b" ".join(planted_by_hand(d.doc_id, d.text)).decode() if d.doc_id and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 10 == 0 else d.text) for d in odd_docs.collect()],
        key=repr,
    )


def test_planted_rows_with_blanks(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:8]
    texts = ["", " \t", "one", " a b\nc\x0bd\te  f g h ", "x\x1cy z\x85w a b c d", " ".join(map(str, range(100))), "é " * 50, None]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id int, text string")
    for r in periodic.with_planted_runs(docs).collect():
        text = texts[ids.index(r.doc_id)]
        assert (r.text is None) == (text is None)
        assert (r.text or "").encode().split() == planted_by_hand(r.doc_id, text)
