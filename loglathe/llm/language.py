"""Language of a text, family first.

A linear model over hashed letter n-grams tells the families apart; inside a family one
support vector machine for each pair of languages votes, so closely related languages
are separated by what differs between just those two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, load

#: Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb".split(),
    "romance": "fr es it pt ca gl ro oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk".split(),
}
#: Training rows of a language, about; and buckets of n-grams.
SAMPLE, BUCKETS = 800, 4096
UNKNOWN = "und"
#: What makes a text one of a language, in learning and predicting alike: superscripts and fractions are none.
LETTER = r"\p{L}"

_KEEP = np.full(256, 32, np.uint8)  # bytes that are no letters count as spaces
_KEEP[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KEEP[128:] = np.arange(128, 256)


def _vector(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams (1 to 3), of length one."""
    data = _KEEP[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)].astype(np.uint32)
    pairs = (data[:-1] << np.uint32(8)) | data[1:]
    triples = (pairs[:-1] << np.uint32(8)) | data[2:]
    counts = np.zeros(BUCKETS)
    for n, grams in enumerate((data, pairs, triples), 1):
        place = ((grams + np.uint32(n << 27)) * np.uint32(2654435761)) >> np.uint32(20)
        counts += np.bincount(place, minlength=BUCKETS)
    counts = np.sqrt(counts)
    return (counts / np.sqrt((counts**2).sum())).astype(np.float32)


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 5.0, steps: int = 150) -> np.ndarray:
    """Linear support vector machine (squared hinge, accelerated gradient); the last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32) * len(y)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(10):
        v = x.T @ (weight * (x @ v))
        top = float(np.sqrt(v @ v)) or 1.0
        v /= top
    lipschitz = 1.0 + 2 * cost * top
    w = look = np.zeros(x.shape[1], np.float32)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ look))
        new = look - (look - 2 * cost * (x.T @ (weight * y * slack))) / lipschitz
        look = new + t / (t + 3) * (new - w)
        w = new
    return w


@dataclass
class Languages:
    """``families`` to their languages; weights of the family models and of each pair."""

    families: dict[str, list[str]]
    family_weights: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        """Language and confidence of each row of ``x``."""
        one = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        names = list(self.families)
        margins = one @ self.family_weights.T if len(names) > 1 else np.full((len(x), 1), 3.0)
        sure = 1 / (1 + np.exp(-3 * margins))
        scores = {pair: one @ w for pair, w in self.pairs.items()}
        out = []
        for i in range(len(x)):
            f = int(margins[i].argmax())
            votes = {lang: [0.0, 0.0] for lang in self.families[names[f]]}
            for a, b in combinations(votes, 2):
                s = float(scores[a, b][i])
                votes[a if s >= 0 else b][0] += 1
                votes[a][1] += s
                votes[b][1] -= s
            best = max(votes, key=lambda lang: (*votes[lang], lang))
            duels = [abs(float(scores[p][i])) for p in combinations(votes, 2) if best in p]
            sure_inside = 1 / (1 + np.exp(-3 * min(duels))) if duels else 1.0
            out.append((best, float(sure[i, f]) * sure_inside))
        return out


def fit(rows: DataFrame, families: dict[str, list[str]] | None = None, sample: int = SAMPLE) -> Languages | None:
    """Fit on ``text, lang, key``: about ``sample`` rows of each language, chosen by a hash of ``key``.

    The sample's n-gram vectors (16 KB each) come to the driver. Null languages and texts
    without a letter are not learned from; with no row left there is no model.
    """
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1_000_000)) / 1_000_000.0
    chosen = usable.filter(draw < F.element_at(share, F.col("lang"))).limit(2 * sample * len(counts))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [_vector(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["lang", "vector"])

    got = chosen.select("lang", "text").mapInArrow(make, "lang string, vector binary").toArrow()
    lang = np.array(got["lang"].to_pylist(), object)
    x = np.array([np.frombuffer(v, np.float32) for v in got["vector"].to_pylist()], np.float32).reshape(-1, BUCKETS)
    found = sorted(set(lang.tolist()))
    if not found:
        return None
    home = {code: name for name, codes in (families or FAMILIES).items() for code in codes}
    tree: dict[str, list[str]] = {}
    for code in found:
        tree.setdefault(home.get(code.lower(), f"only {code}"), []).append(code)
    family = np.array([next(f for f, codes in tree.items() if code in codes) for code in lang], object)
    outer = np.array([_machine(x, np.where(family == f, 1, -1).astype(np.float32)) for f in tree]) if len(tree) > 1 else np.zeros((1, BUCKETS + 1))
    model = Languages(tree, outer.astype(np.float32))
    for codes in tree.values():
        for a, b in combinations(codes, 2):
            either = (lang == a) | (lang == b)
            model.pairs[a, b] = _machine(x[either], np.where(lang[either] == a, 1, -1).astype(np.float32))
    return model


def identify(docs: DataFrame, model: Languages | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row, from the whole text.

    ``und`` with score 0 if the text is null or has no letter, or if there is no model. Texts of
    any length are read whole. Repeated rows get equal answers, of equal
    votes and margins the code that sorts last wins. An empty table gives no rows. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                named = [i for i, t in enumerate(texts) if model and t is not None]
                out = [(UNKNOWN, 0.0)] * len(texts)
                if named:
                    vectors = np.array([_vector(texts[i]) for i in named])
                    for i, answer in zip(named, model.predict(vectors), strict=True):
                        out[i] = answer
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    with_letters = F.when(F.col(text_col).rlike(LETTER), F.col(text_col)).alias("text")
    return docs.select(F.col(id_col).alias("doc_id"), with_letters).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def op4_family_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from documents that are not held out."""
    docs = load(spark, sf_dir, "documents")
    part = crc_mod(F.col("doc_id"), 3)
    model = fit(docs.filter(part != 1).select("text", "lang", F.col("doc_id").alias("key")))
    return identify(docs, model).select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")
