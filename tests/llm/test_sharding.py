"""Shards by byte prefix sums: law, slots, checksums and odd rows."""

import zlib

from tests.conftest import SF01
from wakeline.llm.sharding import N_SHARDS, byte_shards, op3_byte_shards


def test_law_of_near_equal_bytes(spark):
    rows = op3_byte_shards(spark, SF01).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(N_SHARDS))
    assert [r.doc_id for s in sorted(by) for r in by[s]] == sorted(r.doc_id for r in rows)  # contiguous
    assert all([r.slot for r in rs] == list(range(len(rs))) for rs in by.values())
    target, largest = sum(r.size for r in rows) / N_SHARDS, max(r.size for r in rows)
    assert all(abs(sum(r.size for r in rs) - target) <= largest for rs in by.values())


def test_edges(spark, edge_docs, wide_docs, no_docs):
    rows = byte_shards(edge_docs, 4).collect()
    assert len(rows) == edge_docs.count()
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (0, 1)} == {(8, 0)}
    text = {r.doc_id: r.text for r in edge_docs.where("doc_id > 3").collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows if r.doc_id in text)
    assert sorted(map(str, byte_shards(wide_docs, 4).collect())) == sorted(map(str, rows))
    assert byte_shards(no_docs, 4).count() == 0


def test_one_text_with_most_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (100_000 if i == 2 else 10)) for i in range(6)], "doc_id long, text string")
    rows = sorted(byte_shards(docs, 3).collect(), key=lambda r: r.doc_id)
    assert [r.shard for r in rows] == [0, 0, 1, 2, 2, 2]
