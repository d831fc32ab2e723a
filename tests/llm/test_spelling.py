"""Near words against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from loglathe.llm import spelling


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def variants_by_hand(rows):
    n = Counter()
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            at = h % len(run)
            n[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_apart(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v), default=None) for w, vs in near.items()}
    form = {w: v if v and n[v] >= 2 * n[w] else None for w, v in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def words_of(rng, letters, count, longest):
    out = set()
    while len(out) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, longest)))
        out.add(w)
        if rng.random() < 0.7:
            at = rng.randrange(len(w))
            out.add(w[:at] + rng.choice(["", rng.choice(letters), rng.choice(letters) + w[at]]) + w[at + 1 :])
    return [w for w in out if len(w) >= 5]


@pytest.mark.parametrize(("letters", "longest"), [("ab", 9), ("abc", 8), ("abcdefghijéßÿ×", 12)])
def test_all_near_pairs(spark, letters, longest):
    """Few letters: bigrams repeat inside words, pivots and prefixes are full of ties."""
    rng = random.Random(longest)
    words = words_of(rng, letters, 250, longest)
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    got = [(r.a, r.b) for r in spelling.near_pairs(spelling.materialise(frame)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and one_apart(a, b)}


def test_pivots_are_disjoint_and_rarest():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abcde") for _ in range(rng.randint(5, 12)))
        counts = {x + y: rng.randint(1, 9) for x in "abcde" for y in "abcde"}
        rank = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
        places = spelling.prefix(word, rank)
        p, q = spelling.pivots(word, places, counts)
        cost = lambda *ps: sum(counts[word[x : x + 2]] for x in ps)
        assert {p, q} <= set(places) and q - p >= 2
        assert cost(p, q) == min(cost(x, y) for x in places for y in places if y - x >= 2)


def test_rows(spark, frame):
    rng = random.Random(7)
    words = words_of(rng, "abcdeé", 60, 8)
    rows = [(i, " ".join(rng.choice(words).title() if rng.random() < 0.1 else rng.choice(words) for _ in range(80))) for i in range(120)]
    rows += [(None, "Straße straße STRASSE straße naïve naïve naive"), (500, None), (501, ""), (502, "İstanbul ſsssss Kelvin kelvin"), (7, rows[7][1]), (7, rows[7][1])]
    assert {tuple(r) for r in spelling.variants(frame(*rows)).collect()} == variants_by_hand(rows)


def test_chain_of_forms(spark, frame):
    chain = ["alpha", "alphb", "alphbc", "alphbcd", "alphbcde", "alphbcdef"]
    rows = [(None, f"{w} " * 3 * 2**i) for i, w in enumerate(chain)]
    got = {r.word: r for r in spelling.variants(frame(*rows)).collect()}
    assert [got[w].form for w in chain] == [*chain[1:], None]
    assert {r.root for r in got.values()} == {chain[-1]}


def test_odd_rows(spark, odd_docs, no_docs):
    assert spelling.variants(no_docs).collect() == []
    rows = [(d.doc_id, d.text) for d in odd_docs.collect()]
    assert {tuple(r) for r in spelling.variants(odd_docs).collect()} == variants_by_hand(rows)
