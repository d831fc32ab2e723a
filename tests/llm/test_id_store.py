"""Ids written, indexed and read back, against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loglathe.llm import id_store
from loglathe.llm.common import load, scratch_dir
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_query(spark, tokenizer):
    docs = sorted((d.doc_id, d.text) for d in load(spark, SMALL, "documents").collect())
    expected, start = [], 0
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, id_store.op12_perfect_hash_ids(spark, SMALL).collect())) == expected


def test_words_stand_for_texts(tokenizer):
    """Ids of a text are those of its words, whatever characters there are."""
    rng = np.random.default_rng(3)
    pool = list(" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　̈́​'sdtmre<|endoftext|>startof09½²①ÀéßſİΣςǅ日本カ\U0001F600가가-.,!?_A")
    texts = ["".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(4000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "don't we've 'S 'll", "é e ́", "x" * 5000, "ΑΣ ΑΣ. ΑΣΑ"]
    latin = list("ab's'T'Re'LLdÀÖ×÷ØßéÿĀ0912.,-<|>~!\x7f ")
    texts += ["".join(rng.choice(latin, rng.integers(0, 40))) for _ in range(6000)]
    encoder = id_store.Encoder(None, most=500)
    assert encoder.by_word
    got = encoder.of([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_other_rules_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, whole = id_store.Encoder(path), Tokenizer.from_file(path)
    text = "two  blanks\n\nand lines"
    assert not encoder.by_word
    assert np.frombuffer(encoder.of([text.encode()])[0], encoder.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 5000):
        a, b = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        a[: n // 3] = a[:1] if n else a[:0]  # equal first halves
        made = id_store.PerfectHash.load(id_store.PerfectHash.build(a, b).dump())
        assert sorted(made.slots(a, b).tolist()) == list(range(n))
        if n:
            assert len(made.words) * 64 < 8 * n + 64 * 40
    with pytest.raises(ValueError, match="128 bits"):
        id_store.PerfectHash.build(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))


def test_odd_rows(spark, odd_docs, no_docs, tokenizer, monkeypatch):
    # Files and buckets so small that ids and keys spread over many, and one id over several files.
    monkeypatch.setattr(id_store, "FILE_RECORDS", 2)
    monkeypatch.setattr(id_store, "SPAN_RECORDS", 2)
    rows = odd_docs.union(spark.createDataFrame([odd_docs.first().asDict() | {"doc_id": 4, "text": "one"}] * 7, odd_docs.schema)).repartition(3)
    store, places = id_store.write_ids(rows, scratch_dir(spark))
    index = id_store.build_index(places, store, buckets=5)
    assert max(records for _, records, _, _ in store.files) == 2
    id_store.save(store, index)
    assert id_store.open_store(store.root) == (store, index)
    got = id_store.read_ids(id_store.materialise(id_store.look_up(rows, index, store)), store, with_ids=True).collect()
    ids = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(((r.doc_id, ids(r.text)) for r in rows.collect()), key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    for key in (4, None, 5, 8, 9):
        assert sorted(id_store.ids_of(key, index, store)) == sorted(ids(r.text) for r in rows.collect() if r.doc_id == key)
    missing = spark.createDataFrame([(i,) for i in range(1000, 1300)], "doc_id bigint")
    assert id_store.look_up(missing, index, store).count() == 0 and id_store.ids_of(77, index, store) == []

    store, index = id_store.build_store(no_docs, scratch_dir(spark))
    assert index.buckets == 0 and id_store.ids_of(1, index, store) == []
    assert id_store.read_ids(id_store.materialise(id_store.look_up(odd_docs, index, store)), store).count() == 0


def test_text_keys(spark):
    """Keys of any type, also an empty one beside a null one."""
    docs = spark.createDataFrame([("", "a b"), (None, "c"), ("ü/1", "d e f"), ("x", None)], "name string, body string")
    store, index = id_store.build_store(docs, scratch_dir(spark), "name", "body")
    assert [len(id_store.ids_of(k, index, store)[0]) for k in ("", None, "ü/1", "x")] == [3, 2, 4, 1]
