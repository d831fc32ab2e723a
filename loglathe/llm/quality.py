"""Text quality by co-training.

Two views of a page, what its text looks like and what its metadata say, each train a
logistic classifier. Over some rounds each view labels the documents it is sure of for
the other one, if labelled documents that neither has learned from show that it may be
sure. On those both are then calibrated, and their evidence is added. Nothing is sampled:
every document takes part, each Newton step is one pass over the stored features that
adds up a small matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, load, materialise

ROUNDS = 3
#: Probability from which a view labels a document for the other view.
SURE = 0.98
#: Share of right answers, and least number of answers, on which a sure view is trusted.
TRUSTED, TRUSTED_ROWS = 0.95, 5
#: Buckets of hashed sources and languages.
SOURCES, LANGUAGES = 32, 16
_RIDGE = 0.1
_TEXT_FEATURES = 16
VIEWS = ("text", "page")

_ASCII = np.zeros(256, np.int64)  # 1 upper, 2 lower, 3 digit, 4 blank, 5 stop, 6 exclamation, 7 bar, 8 other sign, 0 beyond ASCII
_ASCII[:128] = 8
for _from, _to, _kind in (("A", "Z", 1), ("a", "z", 2), ("0", "9", 3)):
    _ASCII[ord(_from) : ord(_to) + 1] = _kind
for _signs, _kind in ((" \t\n\r\v\f", 4), (".,;:?'\"()-", 5), ("!", 6), ("|", 7)):
    _ASCII[[ord(c) for c in _signs]] = _kind


def text_features(text: str | None) -> list[float]:
    """Shares of kinds of characters, repetition of words and word pairs, lengths."""
    text = text or ""
    kinds = np.bincount(_ASCII[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=9)
    size, words = max(1, len(text)), text.split()
    low, k = text.lower(), max(1, len(words))
    if len(low) == len(text):  # capitals beyond ASCII change when lower-cased
        capitals = int((np.frombuffer(text.encode("utf-32-le", "replace"), "<u4") != np.frombuffer(low.encode("utf-32-le", "replace"), "<u4")).sum())
    else:
        capitals = sum(map(str.isupper, text))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = text.split("\n")
    return [
        capitals / size, (kinds[2] + kinds[0] / 2) / size, kinds[3] / size, kinds[4] / size,
        kinds[5] / k, min(kinds[6] / k, 3), min(kinds[7] / k, 3), min(kinds[8] / k, 3),
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        len(counts) / k, max(counts.values(), default=0) / k,
        float(np.log1p(len(words))), min(len(text) / k, 100) / 10,
        1 - len(set(lines)) / len(lines), float(np.log1p(len(lines))), float(not words),
    ]


def _design(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``doc_id, text_key, text_x, page_x``: the two views of each row.

    The page view has the recorded source, language and the text's size, never the words.
    Nulls have a bucket of their own; a column that ``docs`` lacks counts as null.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def bucket(name: str, of: int):
        value = F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
        return F.coalesce(F.pmod(F.xxhash64(value), F.lit(of - 1)) + 1, F.lit(0)).cast("int") if name in docs.columns else F.lit(0)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            source, lang = (batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 4))
            page = np.zeros((len(texts), SOURCES + LANGUAGES + 2))
            page[np.arange(len(texts)), source] = 1
            page[np.arange(len(texts)), SOURCES + lang] = 1
            page[:, -2] = np.log1p([len(t or "") for t in texts])
            page[:, -1] = [t is None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([text_features(t) for t in texts], pa.list_(pa.float64())), pa.array(list(page), pa.list_(pa.float64()))],
                names=["doc_id", "text_key", "text_x", "page_x"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"),
        bucket(source_col, SOURCES).alias("source_b"), bucket(lang_col, LANGUAGES).alias("lang_b"),
    )
    return rows.mapInArrow(make, f"doc_id {id_type}, text_key bigint, text_x array<double>, page_x array<double>")


@dataclass
class CoTrained:
    """Scale, weights and calibration (slope, offset) of each view, and the log odds of the labels."""

    mean: dict[str, np.ndarray]
    spread: dict[str, np.ndarray]
    weights: dict[str, np.ndarray]
    calibration: dict[str, np.ndarray] = field(default_factory=dict)
    prior: float = 0.0

    def margins(self, view: str, x: np.ndarray) -> np.ndarray:
        return _design(x, self.mean[view], self.spread[view]) @ self.weights[view]

    def score(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """Calibrated log odds of both views, added as independent evidence."""
        odds = -self.prior
        for view in VIEWS:
            slope, offset = self.calibration[view]
            odds = odds + slope * self.margins(view, x[view]) + offset
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _views(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    names = batch.schema.names
    out = {}
    for view in VIEWS:
        column = batch.column(names.index(f"{view}_x"))
        out[view] = column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return out


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.names.index(name)).to_numpy(zero_copy_only=False).astype(float)


def _summed(table: DataFrame, parts) -> np.ndarray:
    """Sum over all rows of the vector that ``parts(batch)`` gives; added up by Spark, so only one vector arrives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = parts(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    added = table.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    rows = sorted((r["i"], r["x"]) for r in added.collect())  # as many as the vector has entries
    return np.array([x for _, x in rows])


def _newton_parts(z: np.ndarray, target: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    h = (z * (weight * p * (1 - p))[:, None]).T @ z
    g = z.T @ (weight * (p - target))
    return np.concatenate([h.reshape(-1), g])


def _newton_step(parts: np.ndarray, w: np.ndarray) -> np.ndarray:
    n = len(w)
    h, g = parts[: n * n].reshape(n, n), parts[n * n :]
    step = np.linalg.solve(h + _RIDGE * np.eye(n), g + _RIDGE * w)
    return w - step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))


def co_train(table: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> CoTrained | None:
    """Fit on stored features with the columns ``label`` and ``check`` (1 good, 0 bad, null unknown).

    Weights are learned from ``label``, trust and calibration from ``check``. Null if
    ``label`` lacks one of the two. Each round starts from the last weights; a document
    that carries either is never relabelled.
    """
    size = {"text": _TEXT_FEATURES, "page": SOURCES + LANGUAGES + 2}

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, label = _views(batch), _column(batch, "label")
        return np.concatenate([[batch.num_rows, (label == 1).sum(), (label == 0).sum()], *[f(x[v]) for v in VIEWS for f in (lambda a: a.sum(0), lambda a: (a**2).sum(0))]])

    total = _summed(table, moments)
    if not len(total) or not total[1] or not total[2]:
        return None
    rows, good, bad = total[:3]
    mean, spread, at = {}, {}, 3
    for v in VIEWS:
        mean[v] = total[at : at + size[v]] / rows
        spread[v] = np.sqrt(np.maximum(total[at + size[v] : at + 2 * size[v]] / rows - mean[v] ** 2, 0)) + 1e-6
        at += 2 * size[v]
    model = CoTrained(mean, spread, {v: np.zeros(size[v] + 1) for v in VIEWS}, prior=float(np.log(good / bad)))

    def trust() -> dict[str, tuple[bool, bool]]:
        """Whether each view may teach bad and good: sure answers on ``check`` are right."""

        def parts(batch: pa.RecordBatch) -> np.ndarray:
            x, check = _views(batch), _column(batch, "check")
            out = []
            for view in VIEWS:
                p = 1 / (1 + np.exp(-np.clip(model.margins(view, x[view]), -30, 30)))
                for says, right in ((p <= 1 - sure, 0), (p >= sure, 1)):
                    out += [says.sum(), (says & (check == right)).sum()]
            return np.array(out, float)

        n = _summed(table.filter("check IS NOT NULL"), parts)
        n = n.reshape(2, 2, 2) if len(n) else np.zeros((2, 2, 2))
        return {v: tuple(bool(n[i, y, 0] >= TRUSTED_ROWS and n[i, y, 1] >= TRUSTED * n[i, y, 0]) for y in (0, 1)) for i, v in enumerate(VIEWS)}

    def pass_over(teacher: CoTrained | None, trusted: dict[str, tuple[bool, bool]], current: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        def parts(batch: pa.RecordBatch) -> np.ndarray:
            x, label = _views(batch), _column(batch, "label")
            known, free = ~np.isnan(label), np.isnan(label) & np.isnan(_column(batch, "check"))
            out = []
            for view, other in zip(VIEWS, reversed(VIEWS), strict=True):
                target, weight = np.where(known, label, 0.0), known.astype(float)
                if teacher is not None:
                    p = 1 / (1 + np.exp(-np.clip(teacher.margins(other, x[other]), -30, 30)))
                    taught = free & ((p >= sure) & trusted[other][1] | (p <= 1 - sure) & trusted[other][0])
                    target, weight = np.where(taught, (p > 0.5).astype(float), target), np.maximum(weight, taught)
                out.append(_newton_parts(_design(x[view], mean[view], spread[view]), target, weight, current[view]))
            return np.concatenate(out)

        total, at = _summed(table, parts), 0
        new = {}
        for view in VIEWS:
            n = size[view] + 1
            new[view] = _newton_step(total[at : at + n * n + n], current[view])
            at += n * n + n
        return new

    for turn in range(rounds):
        teacher = CoTrained(mean, spread, dict(model.weights)) if turn else None
        trusted = trust() if turn else {}
        for _ in range(3 if turn else 8):
            model.weights = pass_over(teacher, trusted, model.weights)

    lines = {v: np.array([1.0, 0.0]) for v in VIEWS}
    for _ in range(4):
        def platt(batch: pa.RecordBatch, lines=lines) -> np.ndarray:
            x, label = _views(batch), _column(batch, "check")
            known = ~np.isnan(label)
            z = {v: np.stack([np.clip(model.margins(v, x[v]), -30, 30), np.ones(len(label))], axis=1) for v in VIEWS}
            return np.concatenate([_newton_parts(z[v], np.where(known, label, 0.0), known.astype(float), lines[v]) for v in VIEWS])

        total = _summed(table.filter("check IS NOT NULL"), platt)
        if not len(total):  # nothing to calibrate on
            break
        lines = {v: _newton_step(total[i * 6 : i * 6 + 6], lines[v]) for i, v in enumerate(VIEWS)}
    model.calibration = lines
    return model


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, score, text_score, page_score`` for each row; score is the probability of good quality.

    Learned from labels of documents whose crc32(id) mod 5 is not 0, those with remainder 1
    for calibration; of several labels of one id the smallest counts, null labels do not. An empty or null text has features like any
    other. Without labels of both kinds every row scores 1: nothing can be rejected.
    Repeated rows score alike, other columns are not read.
    """
    known = labels.filter(F.col(label_col).isNotNull() & (crc_mod(F.col("doc_id"), 5) != 0))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.min(label_col).cast("int").alias("known"))
    part = crc_mod(F.col("label_id"), 5)
    known = known.select("label_id", F.when(part != 1, F.col("known")).alias("label"), F.when(part == 1, F.col("known")).alias("check"))
    table = features(docs, id_col, text_col)
    table = materialise(table.join(known, F.col("doc_id") == F.col("label_id"), "left").drop("label_id"))
    model = co_train(table)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                scores = [np.ones(batch.num_rows)] * 3
            else:
                x = _views(batch)
                views = [model.calibration[v][0] * model.margins(v, x[v]) + model.calibration[v][1] for v in VIEWS]
                scores = [model.score(x), *(1 / (1 + np.exp(-np.clip(z, -50, 50))) for z in views)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(s, pa.float64()) for s in scores)], names=["doc_id", "text_key", "score", "text_score", "page_score"]
            )

    return table.select("doc_id", "text_key", "text_x", "page_x").mapInArrow(run, f"doc_id {id_type}, text_key bigint, score double, text_score double, page_score double")


def drop_bad(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with its columns, without the rows that score under ``least``."""
    bad = materialise(classify(docs, labels).filter(F.col("score") < least).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("k"))
    kept = rows.join(bad, F.col("d").eqNullSafe(F.col("bad_id")) & (F.col("k") == F.col("bad_key")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op5_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scored = classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "page_score",
    )
