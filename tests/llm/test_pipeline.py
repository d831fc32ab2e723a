"""The stages one after the other, each against what it should have done to its own input."""

import __spark_entry__
import corpus_pipeline
from loglathe.llm import decontaminate
from tests.conftest import MEDIUM

from .test_duplicates import components_by_hand, cut_by_hand


def test_stages(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    kept = corpus_pipeline.materialise(stage["quality"](spark, docs, MEDIUM))
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum(quality.get(i) == 1 for i in gone) <= 0.01 * len(quality)
    assert sum(q == 0 and i not in gone for i, q in quality.items()) <= 0.1 * sum(q == 0 for q in quality.values())

    cut = corpus_pipeline.materialise(stage["line_dedup"](spark, kept, MEDIUM))
    assert cut.columns == docs.columns and sorted(rows(cut), key=repr) == cut_by_hand(rows(kept))
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    alone = corpus_pipeline.materialise(stage["near_dedup"](spark, cut, MEDIUM))
    expected = sorted(i for i, _, c in components_by_hand(rows(cut), 5) if i == c)
    assert alone.columns == docs.columns and sorted(i for i, _ in rows(alone)) == expected

    clean = corpus_pipeline.materialise(stage["decontaminate"](spark, alone, MEDIUM))
    bench = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    flagged = {r.doc_id for r in decontaminate.report(alone, bench).collect() if r.contaminated}
    assert clean.columns == docs.columns
    assert {i for i, _ in rows(alone)} - {i for i, _ in rows(clean)} == flagged

    packed = stage["packing"](spark, clean, MEDIUM).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows(clean)}
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_empty_and_odd_tables(spark, odd_docs, no_docs):
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, corpus_pipeline.materialise(stage(spark, docs, MEDIUM))
            assert name == "packing" or docs.columns == before.columns
        assert (docs.count() > 0) == (start is odd_docs)


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} == {n for n in names if n == "pipeline" or n.startswith("op")}
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "packing"]
