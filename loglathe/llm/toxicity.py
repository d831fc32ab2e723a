"""Toxic documents and the sentences that make them so, by multiple-instance learning.

A document is a bag of sentences. A linear model gives each sentence a probability and
noisy-or combines them: a document is toxic unless every sentence is harmless. Training
needs labels of documents only, and the same sentence scores then locate the offence.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, load

#: Labelled documents to fit on, of each label at most, chosen by a hash of their id.
SAMPLE = 3_000
#: Features that enter the model, those that differ most between the classes.
VOCABULARY = 8192
#: A word's features are the word and its openings of these lengths: insults inflect.
OPENINGS = (3, 4, 5, 6)

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"\w+")


def _features(word: str) -> list[int]:
    names = [f"={word}", *(f"^{word[:n]}" for n in OPENINGS if len(word) > n)]
    return [zlib.crc32(n.encode("utf-8", "replace")) for n in names]


@dataclass
class NoisyOr:
    """Weights of feature codes and the bias of a sentence."""

    weights: dict[int, float]
    bias: float


def fit(sample: DataFrame, vocabulary: int = VOCABULARY, steps: int = 300) -> NoisyOr | None:
    """Fit on rows ``text, label, weight``; null if one of the labels is missing.

    The caller bounds the rows (``sample_labels``), as their texts come to the driver.
    Adam on the weighted noisy-or likelihood with a small ridge.
    """
    rows = sample.select("text", "label", "weight").toArrow()
    label = np.array(rows["label"].to_pylist(), np.float64)
    weight = np.array(rows["weight"].to_pylist(), np.float64)
    if not len(label) or label.min() == label.max():
        return None

    # Flat arrays of numbers: the distinct words of each sentence, and the sentences of each document.
    number: dict[str, int] = {}
    tokens, sentence_words, doc_sentences = array("i"), array("i"), array("i")
    for chunk in rows["text"].chunks:
        for text in chunk.to_pylist():
            sentences = _SENTENCE.findall(text or "")
            doc_sentences.append(len(sentences))
            for s in sentences:
                words = set(_WORD.findall(s.lower()))
                sentence_words.append(len(words))
                tokens.extend([number.setdefault(w, len(number)) for w in words])
    del rows
    tokens, sentence_words = np.frombuffer(tokens, np.int32), np.frombuffer(sentence_words, np.int32)
    codes, per_word = array("L"), array("i")
    for w in number:
        of_word = _features(w)
        codes.extend(of_word)
        per_word.append(len(of_word))
    del number
    codes, feature = np.unique(np.array(codes, np.uint32), return_inverse=True)
    per_word = np.array(per_word, np.int64)
    first = np.cumsum(per_word) - per_word

    def expand(words: np.ndarray) -> np.ndarray:
        """Features of the words, one after the other."""
        sizes = per_word[words]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return feature[np.repeat(first[words], sizes) + inside]

    # Shares of the toxic and the harmless documents that have a feature.
    have = np.zeros((2, len(codes)))
    doc_of = np.repeat(np.arange(len(label)), np.array(doc_sentences, np.int64))
    word_doc = np.repeat(doc_of, sentence_words)
    edges = np.searchsorted(word_doc, np.arange(len(label) + 1))
    for d, y in enumerate(label):
        have[int(y), np.unique(expand(np.unique(tokens[edges[d] : edges[d + 1]])))] += 1
    share = have / np.array([[(label == 0).sum()], [(label == 1).sum()]])
    differs = np.abs(share[1] - share[0]) / np.sqrt(share.sum(axis=0) + 1e-9)
    frequent = have.sum(axis=0) >= 3
    differs[~frequent] = 0
    chosen = np.sort(np.argsort(-differs, kind="stable")[: min(vocabulary, int(frequent.sum()))])
    place = np.full(len(codes), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    # A word keeps its chosen features only.
    kept = place[feature] >= 0
    feature = place[feature[kept]]
    per_word = np.bincount(np.repeat(np.arange(len(per_word)), per_word)[kept], minlength=len(per_word))
    first = np.cumsum(per_word) - per_word
    word = expand(tokens)
    sentence = np.repeat(np.repeat(np.arange(len(sentence_words)), sentence_words), per_word[tokens])
    chosen = codes[chosen]
    n_sentences, n_docs = len(doc_of), len(label)
    weight = weight / weight.sum()

    w, bias = np.zeros(len(chosen)), -6.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(sentence, weights=w[word], minlength=n_sentences) + bias
        p = 1 / (1 + np.exp(-z))
        harm = np.bincount(doc_of, weights=np.logaddexp(0, z), minlength=n_docs)
        free = np.exp(-harm)
        of_doc = weight * ((1 - label) - label * free / np.maximum(1 - free, 1e-9))
        of_sentence = of_doc[doc_of] * p
        grad = np.bincount(word, weights=of_sentence[sentence], minlength=len(w)) + 2e-5 * w
        grad_b = of_sentence.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b**2
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        bias -= 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return NoisyOr(dict(zip(chosen.tolist(), w.tolist(), strict=True)), float(bias))


def score(docs: DataFrame, model: NoisyOr | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, sentences, offending`` for each row.

    ``offending`` lists the sentences with a probability of 0.5 or more, or the worst one
    of a document that only reaches 0.5 as a whole, with character positions. A null or
    empty text has no sentence and scores 0, as does everything without a model.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, score double, sentences bigint, offending array<struct<begin:bigint,end:bigint,score:double>>"
    item = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = (model.weights, model.bias) if model else ({}, -np.inf)
        cache: dict[str, float] = {}

        def weight(word: str) -> float:
            if len(cache) > 500_000:
                cache.clear()
            cache[word] = value = sum(weights.get(c, 0.0) for c in _features(word))
            return value

        for batch in batches:
            scores, counts, found = [], [], []
            for text in batch.column(1).to_pylist():
                spans, sums = [], []
                for match in _SENTENCE.finditer(text or ""):
                    words = set(_WORD.findall(match.group().lower()))
                    sums.append(sum([x if (x := cache.get(w)) is not None else weight(w) for w in words]))
                    spans.append(match.span())
                z = np.array(sums, np.float64) + bias
                total = float(-np.expm1(-np.logaddexp(0, z).sum())) if len(z) else 0.0
                p = 1 / (1 + np.exp(-z))
                bad = np.flatnonzero(p >= 0.5)
                if total >= 0.5 and not len(bad):
                    bad = np.array([int(p.argmax())])
                scores.append(total), counts.append(len(spans))
                found.append([{"begin": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in bad])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(found, pa.list_(item))],
                names=["doc_id", "score", "sentences", "offending"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def sample_labels(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE) -> DataFrame:
    """``text, label, weight`` of up to ``rows`` documents of each label that are not held out.

    ``weight`` is how many labelled documents one of the sample stands for. Labels that
    are null do not count; of several labels of one id the largest counts.
    """
    usable = labels.filter(F.col(label_col).isNotNull() & (crc_mod(F.col("doc_id"), 5) != 0))
    usable = usable.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    sizes = usable.groupBy("label").count()
    first = [usable.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = first[0].unionByName(first[1]).join(F.broadcast(sizes), "label")
    chosen = chosen.withColumn("weight", F.col("count") / F.least(F.col("count"), F.lit(rows)))
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    # Two numbers a row and at most 2 x ``rows`` of them. Documents that repeat an id could exceed the bound.
    return texts.join(F.broadcast(chosen), texts["id"] == chosen["doc_id"]).select("text", "label", "weight").limit(4 * rows)


def op1_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labels of documents that are not held out."""
    docs = load(spark, sf_dir, "documents")
    model = fit(sample_labels(docs, load(spark, sf_dir, "labels"), "toxic"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
        "offending",
    )
