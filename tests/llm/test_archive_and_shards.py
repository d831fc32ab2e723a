import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loglathe.llm import sharding, warc
from loglathe.llm.common import scratch_dir
from tests.conftest import SMALL


def by_hand(rows):
    first = {}
    for i, html in rows:
        if i is not None and (html or "") not in first or i is not None and i < first[html or ""]:
            first[html or ""] = i
    out = Counter()
    for i, html in rows:
        data, keep = (html or "").encode(), first.get(html or "")
        kind = "revisit" if i != keep and sum((h or "") == (html or "") for _, h in rows) > 1 else "response"
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, keep if kind == "revisit" else None] += 1
    return out


def through_files(spark, pages):
    root = scratch_dir(spark)
    captures = warc.write_archive(pages, root)
    index = warc.build_index(captures, root)
    found = warc.read_records(warc.materialise(warc.look_up(captures.select("key", "page"), index)), root)
    rows = Counter(
        (int(r.page) if r.page else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in found.collect()
    )
    return rows, index


def test_all_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert through_files(spark, pages)[0] == by_hand([(r.page_id, r.html) for r in pages.collect()])
    assert {r.page_id for r in warc.op6_two_level_index(spark, SMALL).collect()} == {r.page_id for r in pages.collect()}


def test_odd_pages_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    rows = [(i, f"http://h{i % 3}.example.com/p{i % 4}", f"<p>{i % 5}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://a b\r\nX: y/é", "x"), (None, "http://h1.example.com/p1", "<p>1</p>"), (7, "http://h1.example.com/p3", "<p>2</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, key string")
    got, index = through_files(spark, pages)
    assert got == by_hand([(i, h) for i, _, h in rows])
    for url in ("http://h1.example.com/p1", "http://h2.example.com/p3#top", "http://nowhere.example.com/"):
        hits = warc.captures_of_url(index, url)
        assert len(hits) == sum(u is not None and warc.url_key(u) == warc.url_key(url) for _, u, _ in rows)
    assert through_files(spark, pages.limit(0))[0] == Counter()


def test_records_are_valid_members():
    member = warc.record("3", "http://www.Example.com/ä b", b"<p>\xc3\xa4</p>", None, False)
    fields, http, payload = warc.parse(member)
    assert payload == b"<p>\xc3\xa4</p>" and fields["warc-type"] == "response" and http["content-length"] == str(len(payload))
    assert zlib.decompress(member, wbits=31).endswith(b"\r\n\r\n")
    assert warc.url_key("http://u@WWW.Example.com:8080/a?b#c") == "com,example,www:8080)/a?b"


# shards


@pytest.fixture
def keys(spark):
    return spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 7).alias("text"))


def by_tree(key, node, path):
    import math

    while node.children:
        def draw(c):
            digits = int(hashlib.md5(f"{key}|{path}/{c.name}".encode()).hexdigest()[:13], 16)
            return -math.log((digits + 1) / (2**52 + 1)) / c.weight

        live = [c for c in node.children if c.weight > 0]
        node = live[0] if len(live) == 1 else min(live, key=draw)
        path = f"{path}/{node.name}"
    return node.shard


def test_shards_equal_a_walk_by_hand(spark):
    tree, grown = sharding.balanced_tree(), sharding.grow(sharding.balanced_tree(), 8)
    for r in sharding.op9_hash_tree_shards(spark, SMALL).collect():
        assert r.shard == by_tree(r.doc_id, tree, "root") and r.grown_shard == by_tree(r.doc_id, grown, "root")


def test_growth_moves_rows_only_into_the_new_shard(keys):
    tree = sharding.balanced_tree()
    rows = keys.select(sharding.shard_of(F.col("doc_id"), tree).alias("a"), sharding.shard_of(F.col("doc_id"), sharding.grow(tree, 8)).alias("b")).collect()
    assert all(r.b in (r.a, 8) for r in rows)
    assert 300 < sum(r.b == 8 for r in rows) < 600
    assert all(350 < n < 650 for n in Counter(r.a for r in rows).values())


def test_weight_change_stays_in_its_subtree(keys):
    N = sharding.Node
    tree = lambda w: N("root", children=(N("r0", children=(N("s0", 0), N("s1", 1))), N("r1", children=(N("s0", 2, w), N("s1", 3, 2 - w)))))
    rows = keys.select(sharding.shard_of(F.col("doc_id"), tree(1.0)).alias("a"), sharding.shard_of(F.col("doc_id"), tree(0.5)).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    assert moved and set(moved) == {(2, 3)}


def test_slots_and_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_rows(odd_docs, sharding.balanced_tree(), parts=4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == odd_docs.count() and all(sorted(s) == list(range(len(s))) for s in slots.values())
    data = {(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == data
    assert sharding.shard_rows(no_docs, sharding.balanced_tree()).collect() == []
