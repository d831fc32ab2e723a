"""The trained operators: held-out accuracy, odd rows, and learning from nothing."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm import language, quality, toxicity
from tests.conftest import MEDIUM, SMALL


def crc(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


@pytest.fixture(scope="module")
def bags(spark):
    """Texts of plain words; toxic ones hold one insulting sentence among many harmless ones."""
    draw = random.Random(3)
    words = [f"{a}{b}" for a in "bo ka li mu ne pa ro su".split() for b in "dan fel gor hin jat".split()]
    sentence = lambda: " ".join(draw.choice(words) for _ in range(8)).capitalize() + "."
    rows = []
    for i in range(1200):
        toxic = i % 4 == 0
        parts = [sentence() for _ in range(draw.randint(1, 12))]
        if toxic:
            parts.insert(draw.randint(0, len(parts)), f"{sentence()[:-1]} grumf{draw.choice(['ig', 'el', 'om', 'ast', 'ur'])} {draw.choice(words)}.")
        rows.append((i, " ".join(parts), int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").cache()


def test_toxic_sentences_are_found_from_document_labels(bags):
    model = toxicity.fit(toxicity.sample_labels(bags, bags.select("doc_id", "toxic"), "toxic"))
    truth = {r.doc_id: r for r in bags.collect()}
    held = [r for r in toxicity.score(bags, model).collect() if crc(r.doc_id, 5) == 0]
    right = sum((r.score >= 0.5) == bool(truth[r.doc_id].toxic) for r in held)
    assert right / len(held) > 0.97
    located = [r for r in held if truth[r.doc_id].toxic and r.score >= 0.5]
    inside = [all("grumf" in truth[r.doc_id].text[o.begin : o.end].lower() for o in r.offending) and len(r.offending) > 0 for r in located]
    assert sum(inside) / len(inside) > 0.95


def test_toxicity_of_odd_rows(bags, odd_docs, no_docs):
    labels = bags.select("doc_id", "toxic")
    model = toxicity.fit(toxicity.sample_labels(bags, labels, "toxic"))
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.sentences == 0 for r in rows if r.doc_id in (1, 2))
    assert toxicity.score(no_docs, model).collect() == []
    assert toxicity.fit(toxicity.sample_labels(bags, labels.filter("toxic = 0"), "toxic")) is None
    assert toxicity.fit(toxicity.sample_labels(bags.limit(0), labels, "toxic")) is None
    assert {r.score for r in toxicity.score(bags.limit(5), None).collect()} == {0.0}


def test_labels_are_read_only_where_not_held_out(bags):
    from pyspark.sql import functions as F

    labels = bags.select("doc_id", "toxic")
    spoiled = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(toxicity.sample_labels(bags, x, "toxic")) for x in (labels, spoiled))
    assert a.weights == b.weights and a.bias == b.bias


def test_language_of_held_out_documents(spark):
    rows = language.op4_family_language(spark, MEDIUM).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("text", "lang", "doc_id as key")
    model = language.fit(docs)
    rows = language.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 9)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, 8)} <= {"en", "de", "fr", "es"}
    assert language.identify(no_docs, model).collect() == []
    assert language.fit(docs.filter("lang IS NULL")) is None
    assert {r.lang_pred for r in language.identify(odd_docs, None).collect()} == {"und"}


def test_texts_without_letters_have_no_language(spark):
    """Superscripts, fractions and number signs are no letters; learning and predicting agree."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang", F.col("doc_id").alias("key"))
    model = language.fit(docs)
    texts = ["²³", "½ ①", "12 %", "_", "x²", "½ ª", "é", "日"]
    got = {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    assert [got[i] == "und" for i in range(8)] == [True] * 4 + [False] * 4


def test_language_levels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("text", "lang", "doc_id as key")
    model = language.fit(docs)
    assert sorted(map(sorted, model.families.values())) == [["de", "en"], ["es", "fr"]]
    assert sorted(model.pairs) == [("de", "en"), ("es", "fr")]
    alone = language.fit(docs.filter("lang = 'fr'"))
    assert {r.lang_pred for r in language.identify(docs.selectExpr("key doc_id", "text").limit(5), alone).collect()} == {"fr"}


def test_quality_of_held_out_documents(spark):
    rows = {r.doc_id: r for r in quality.op5_co_trained_quality(spark, MEDIUM).collect()}
    labels = [r for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect() if r.doc_id in rows]
    held = [r for r in labels if rows[r.doc_id].held_out]
    assert sum(rows[r.doc_id].predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(no_docs, labels).collect() == []
    assert {r.score for r in quality.classify(docs, labels.filter("quality = 1")).collect()} == {1.0}
    kept = quality.drop_bad(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()
    assert quality.drop_bad(docs, labels.limit(0)).count() == docs.count()


def test_views_teach_each_other(spark):
    """With few labels, a telling source teaches the text view through unlabelled documents."""
    draw = random.Random(1)
    rows = []
    for i in range(1500):
        good = i % 2 == 0
        text = " ".join(draw.choice(["alpha", "beta", "gamma", "delta"]) + ("" if good or draw.random() < 0.3 else "###") for _ in range(30))
        rows.append((i, text, "en", "clean" if good else "junk", len(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id bigint, quality int")
    got = quality.classify(docs, labels).collect()
    assert sum((r.text_score >= 0.5) == (r.doc_id % 2 == 0) for r in got) / len(got) > 0.97
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in got) / len(got) > 0.97


def test_toxicity_scores_equal_plain_sums(bags, odd_docs):
    """Each score again from the fitted weights: a word at a time, sentence probabilities multiplied out."""
    model = toxicity.fit(toxicity.sample_labels(bags, bags.select("doc_id", "toxic"), "toxic"))
    for docs in (bags, odd_docs.select("doc_id", "text")):
        truth = Counter()
        for r in docs.collect():
            harmless, bad, best = 1.0, [], None
            for m in re.finditer(r"[^.!?\n]+[.!?]*", r.text or ""):
                z = model.bias
                for word in set(re.findall(r"\w+", m.group().lower())):
                    for name in [f"={word}"] + [f"^{word[:n]}" for n in (3, 4, 5, 6) if n < len(word)]:
                        z += model.weights.get(zlib.crc32(name.encode()), 0.0)
                p = 1 / (1 + math.exp(-z))
                harmless *= 1 - p
                bad += [m.span()] if p >= 0.5 else []
                best = max(best or (p, m.span()), (p, m.span()), key=lambda b: b[0])
            score = 1 - harmless if best else 0.0
            truth[r.doc_id, round(score, 6), tuple(bad) or ((best[1],) if score >= 0.5 else ())] += 1
        got = Counter((r.doc_id, round(r.score, 6), tuple((o.begin, o.end) for o in r.offending)) for r in toxicity.score(docs, model).collect())
        assert got == truth


def test_languages_equal_recounted_votes(spark):
    """N-grams counted one by one, the family with the largest margin, then the votes of its pairs."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("text", "lang", "doc_id as key")
    model = language.fit(docs, {"mixed": ["en", "fr", "de"]})
    assert len(model.pairs) == 3 and len(model.families) == 2
    rows = [r for r in docs.collect() if r.text and len(r.text) < 5000 and re.search(r"[^\W\d_]", r.text)]
    got = {r.doc_id: r for r in language.identify(docs.selectExpr("key doc_id", "text"), model).collect()}
    compared = 0
    for r in rows:
        data = [b if 97 <= b <= 122 or b >= 128 else 32 for b in f" {r.text.lower()} ".encode()]
        counts = Counter()
        for n in (1, 2, 3):
            for gram in zip(*[data[i:] for i in range(n)]):
                value = int.from_bytes(bytes(gram), "big") + (n << 27)
                counts[(value * 2654435761 % 2**32) >> 20] += 1
        size = math.sqrt(sum(counts.values()))
        margin = lambda w: float(w[-1]) + sum(math.sqrt(c) / size * float(w[k]) for k, c in counts.items())
        family, best = max(zip(model.families, map(margin, model.family_weights), strict=True), key=lambda f: f[1])
        duels = {(a, b): margin(model.pairs[a, b]) for a, b in combinations(model.families[family], 2)}
        votes = Counter(a if s >= 0 else b for (a, b), s in duels.items())
        won = max(model.families[family], key=lambda code: votes[code])
        if not duels or votes[won] == 2:  # no circle of three
            compared += 1
            inside = min((abs(s) for pair, s in duels.items() if won in pair), default=math.inf)
            assert got[r.key].lang_pred == won
            assert got[r.key].score == pytest.approx(1 / (1 + math.exp(-3 * best)) / (1 + math.exp(-3 * inside)), abs=1e-3)
    assert compared > 0.9 * len(rows)


def test_quality_equals_steps_over_whole_arrays(spark):
    """The rounds again on arrays that hold all rows: fit, trust, teach, calibrate, add."""
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.features(docs).collect()
    given = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}
    pick = lambda parts: np.array([given.get(r.doc_id, np.nan) if crc(r.doc_id, 5) in parts else np.nan for r in rows])
    label, check = pick({2, 3, 4}), pick({1})
    known, checked = ~np.isnan(label), ~np.isnan(check)
    free = ~known & ~checked
    views = ("text", "page")
    z = {}
    for view in views:
        x = np.array([r[f"{view}_x"] for r in rows])
        z[view] = np.c_[(x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), np.ones(len(x))]
    sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(m, -30, 30)))

    def newton(design, target, weight, w):
        p = sigmoid(design @ w)
        hessian = design.T @ np.diag(weight * p * (1 - p)) @ design + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (weight * (p - target)) + 0.1 * w)
        return w - step * min(1, 5 / np.abs(step).max())

    w = {v: np.zeros(z[v].shape[1]) for v in views}
    taught = 0
    for turn in range(3):
        sure = {}
        for view in views:
            p = sigmoid(z[view] @ w[view])
            sure[view] = np.full(len(rows), np.nan)
            for says, answer in ((p <= 0.02, 0.0), (p >= 0.98, 1.0)):
                right = (check[says & checked] == answer).sum()
                if turn and (says & checked).sum() >= 5 and right >= 0.95 * (says & checked).sum():
                    sure[view][says & free] = answer
            taught += (~np.isnan(sure[view])).sum()
        for _ in range(3 if turn else 8):
            new = {}
            for view, other in (views, views[::-1]):
                target = np.where(known, label, sure[other])
                new[view] = newton(z[view], np.nan_to_num(target), (~np.isnan(target)).astype(float), w[view])
            w = new
    assert taught > 0
    odds = -np.log((label == 1).sum() / (label == 0).sum())
    for view in views:
        margin, line = z[view] @ w[view], np.array([1.0, 0.0])
        for _ in range(4):
            line = newton(np.c_[np.clip(margin, -30, 30), np.ones(len(rows))], np.nan_to_num(check), checked.astype(float), line)
        odds = odds + line[0] * margin + line[1]
    got = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], 1 / (1 + np.exp(-odds)), atol=1e-4)
