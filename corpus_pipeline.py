"""From documents to packed training sequences.

Each stage works on all that the stage before it has kept and takes effect at once:
rejected documents go, repeated passages are cut out, one document of each group of near
copies stays, benchmark passages go. What a stage returns is written and read again, so
a lost executor costs one stage's tasks, never the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.llm import decontaminate, line_dedup, near_dup, packing, quality
from loglathe.llm.common import load, materialise


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Co-trained quality classifier: documents of bad quality go."""
    return quality.drop_bad(docs, load(spark, sf_dir, "labels"))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of three lines or more that an earlier document has are cut; ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs)
    sizes = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cut.select(*[sizes[c].alias(c) if c in sizes else F.col(f"`{c}`") for c in cut.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, 0.8)."""
    return near_dup.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents in sequences of 2,048."""
    return packing.pack(materialise(packing.pieces(docs, added_tokens=True)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_bad),
    ("line_dedup", cut_lines),
    ("near_dedup", drop_copies),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs


#: Classifier, estimate and tokenizer are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
