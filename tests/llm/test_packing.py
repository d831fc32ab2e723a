import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loglathe.llm import packing
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(spark, rows, placed, tokenizer):
    """Each id lies in one piece, pieces lie gapless in their sequences."""
    from collections import Counter, defaultdict

    expected = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), packing.MAX_LEN):
            piece = np.array(ids[at : at + packing.MAX_LEN], "<u4")
            expected[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in placed) == expected
    sequences = defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.MAX_LEN
    return sequences


def test_all_documents(spark, tokenizer):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    placed = packing.op3_shortest_pack_first(spark, SMALL).collect()
    sequences = check(spark, [(r.doc_id, r.text) for r in df.collect()], placed, tokenizer)
    used = sum(r.length for r in placed)
    assert used / (len(sequences) * packing.MAX_LEN) > 0.97
    assert sorted(sequences) == list(range(len(sequences)))


def test_odd_rows(spark, odd_docs, no_docs, tokenizer):
    placed = packing.pack(packing.materialise(packing.pieces(odd_docs))).collect()
    check(spark, [(r.doc_id, r.text) for r in odd_docs.collect()], placed, tokenizer)
    assert packing.pack(packing.materialise(packing.pieces(no_docs))).collect() == []


def test_ids_come_along(spark, frame):
    parts = packing.materialise(packing.pieces(frame((1, "hello world"), (2, None)), with_ids=True))
    rows = {r.doc_id: r for r in packing.pack(parts).collect()}
    assert rows[2].ids == [1] and rows[1].ids[-1] == 1 and len(rows[1].ids) == rows[1].length


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_every_item(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(2048, draw.lognormal(5.5 + seed, 1, 3000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=2049)
    patterns = packing.shortest_pack_first(histogram, 2048)
    items = np.zeros(2049, int)
    for count, pattern in patterns:
        assert sum(length * times for length, times in pattern) <= 2048
        for length, times in pattern:
            items[length] += count * times
    assert (items == histogram).all()


def test_longest_first_into_most_room():
    histogram = np.zeros(11, int)
    histogram[[6, 5, 3, 2]] = [1, 1, 2, 1]
    # 6 opens a pack, 5 another (4 left is too little), 3 goes to the emptier one, and so on
    patterns = packing.shortest_pack_first(histogram, 10)
    assert sorted(p for _, p in patterns) == [((5, 1), (3, 1), (2, 1)), ((6, 1), (3, 1))]


def test_added_tokens_inside_texts(spark, frame, tmp_path):
    """op3 and the pipeline's stage give the ids of the tokenizer as loaded."""
    import corpus_pipeline

    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "one<|endoftext|>two"), (2, "<|endoftext|>"), (3, "a <|endoftext|> b<|endoftext|><|endoftext|>\n c <|endoftext|"), (4, "plain"), (5, None)]
    assert loaded.encode(rows[0][1], add_special_tokens=False).ids == [505, 50256, 11545]
    frame(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, rows, packing.op3_shortest_pack_first(spark, str(tmp_path)).collect(), loaded)
    check(spark, rows, dict(corpus_pipeline.STAGES)["packing"](spark, frame(*rows), str(tmp_path)).collect(), loaded)
