"""Importance resampling: checksums, brute force on small tables, odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm.resample import Resampling, bucket_counts, crc32_all, resample


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=40))
def test_checksums(values):
    got = crc32_all(pa.array(values, pa.binary()))
    assert got.dtype == np.uint32 and got.tolist() == [zlib.crc32(v) for v in values]


def test_checksums_of_a_slice():
    assert crc32_all(pa.array([b"a", b"bc", b"", b"d" * 1000], pa.binary()).slice(1)).tolist() == [
        zlib.crc32(b"bc"), 0, zlib.crc32(b"d" * 1000)]


def features(text, max_run):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, [" ".join(words[i:i + k]) for k in range(1, max_run + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, p):
    bucket = lambda f: zlib.crc32(f.encode()) % p.n_buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, p.max_run)[1])
    t = Counter(bucket(f) for x in target for f in features(x, p.max_run)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + p.n_buckets) / ((s[b] + 1) * (n_t + p.n_buckets)))) for b in range(p.n_buckets)]
    rows = []
    for i, text in docs:
        words, found = features(text, p.max_run)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in rows if r[1] >= p.min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(able[: p.percent * len(able) // 100], 1)}
    return [(r[0], *r[2:], rank.get(id(r))) for r in rows]


@pytest.mark.parametrize("max_run,percent", [(1, 10), (3, 50)])
def test_brute_force(spark, edge_docs, wide_docs, max_run, percent):
    p = Resampling(max_run=max_run, percent=percent, min_words=4, n_buckets=997)
    target = ["The of and TO in a", None, "", "prose é with w3é w4é", "x" * 600]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, bucket long")
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = sorted(map(str, brute(docs, target, p)))
    assert sorted(str(tuple(r)) for r in resample(edge_docs, bench, p).collect()) == want
    assert sorted(str(tuple(r)) for r in resample(wide_docs, bench, p).collect()) == want


def test_runs_across_chunks(spark, monkeypatch):
    from wakeline.llm import resample as module

    monkeypatch.setattr(module, "WORDS_PER_CHUNK", 7)
    texts = pa.array([" ".join(f"w{i}" for i in range(40)), None, "a b", "c"])
    for run in (1, 2, 4):
        want = Counter(f for t in texts.to_pylist() for f in features(t, run)[1])
        got = Counter(v.decode() for _, runs in module._features(texts, run) for v in runs.to_pylist())
        assert got == want


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resample(no_docs, bench).count() == 0
    assert bucket_counts(no_docs).count() == 0
    assert resample(one, bench.limit(0)).first().n_features == 40


def test_target_words_are_drawn(spark):
    """Documents of the target's words rank before others of the same length."""
    docs = spark.createDataFrame([(i, ("cat mat hat " if i < 100 else "dog log fog ") * 10) for i in range(1000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "cat mat hat " * 50)], "item_id long, text string")
    assert {r.doc_id for r in resample(docs, bench).where("rank is not null").collect()} == set(range(100))
