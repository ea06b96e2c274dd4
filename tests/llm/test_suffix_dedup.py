"""Suffix arrays against sorting, and removal of repeats against brute force."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from wakeline.llm.suffix_array import permuted_common_prefixes, suffix_array
from wakeline.llm.suffix_dedup import MatchParams, op1_suffix_dedup, remove_repeats, repeated_starts, segments_of


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_suffix_array_is_the_sorted_order(letters):
    rng = np.random.default_rng(letters)
    for n in range(1, 70):
        s = np.append(rng.integers(1, letters + 1, n), 0)
        order = suffix_array(s, letters + 1)
        text = bytes(s.astype(np.uint8))
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        common = permuted_common_prefixes(s.astype(np.uint8), order, 20)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            shared = next((k for k in range(20) if k >= min(len(text) - a, len(text) - b) or text[a + k] != text[b + k]), 20)
            assert common[b] == shared


def test_equal_strings_share_anchor_and_offset():
    rng = random.Random(1)
    passage = bytes(rng.randrange(97, 123) for _ in range(60))
    texts = [bytes(rng.randrange(97, 123) for _ in range(40)) + passage + bytes(rng.randrange(97, 123) for _ in range(30)) for _ in range(2)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.array([0, 130, 260])
    s = segments_of(data, offsets, 20, 8)
    anchor_of = {}
    for a, b, h in zip(s.start.tolist(), s.end.tolist(), s.anchor.tolist()):
        for p in range(a, b - 19):
            anchor_of[p] = h
    assert sorted(anchor_of) == [*range(0, 111), *range(130, 241)]  # every string start is in one segment
    assert all(anchor_of[40 + k] == anchor_of[170 + k] for k in range(41))


def test_repeated_starts_in_one_shard():
    data = np.frombuffer(b"abcdeabcde" + b"xabcdy", np.uint8)
    hits = repeated_starts(data, np.array([10, 6]), np.concatenate([np.arange(10), (1 << 32) + np.arange(6)]), 4)
    assert hits.tolist() == [5, 6, 11]


def brute(rows, match):
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        b = (text or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - match + 1):
            w = b[p:p + match]
            if w in seen:
                gone[p:p + match] = [True] * match
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("seed,crowd", [(1, 4000), (2, 4000), (3, 1), (4, 2)])
def test_against_brute_force(spark, seed, crowd):
    """A small ``crowd`` splits anchors' segments into strings."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(pool)[:rng.randint(1, 60)] for _ in range(rng.randint(0, 6)))
        text = "a" * rng.randint(0, 50) if i % 9 == 0 else rows[-1][1] if i % 10 == 3 else None if i % 17 == 5 else text
        rows.append((i, text))
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), MatchParams(12, 5, crowd))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got.collect()) == brute(rows, 12)


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    import hashlib

    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 100)]
    assert sorted(tuple(r) for r in op1_suffix_dedup(spark, SF001).collect()) == want
    assert sum(r[2] for r in want) > 0


def test_edges(spark, edge_docs, wide_docs, no_docs):
    got = remove_repeats(edge_docs).select("doc_id", "n_bytes", "n_removed", "kept_text").collect()
    assert len(got) == edge_docs.count()
    # a null doc_id comes first, so the rows 5 and 6 that repeat its text lose all of it, the repeated rows alike
    assert [r.n_removed for r in got if r.doc_id is None and r.n_bytes] == [0]
    assert {r.n_removed == r.n_bytes for r in got if r.doc_id in (5, 6)} == {True}
    assert [r.n_removed for r in got if r.doc_id == 8] == [50_000 - 1]
    as_rows = lambda df: sorted(map(str, df.select("doc_id", "n_removed", F.sha2("kept_bytes", 256)).collect()))
    assert as_rows(remove_repeats(wide_docs)) == as_rows(remove_repeats(edge_docs))
    assert remove_repeats(no_docs).count() == 0


def test_cut_characters_leave_the_text(spark):
    a, b = "é" * 60, "x" + "é" * 60
    got = remove_repeats(spark.createDataFrame([(1, a), (2, "à" + a[1:])], "doc_id long, text string"), MatchParams(11, 5)).collect()
    assert all(r.kept_text == bytes(r.kept_bytes).decode("utf-8", "ignore") for r in got)
    assert b
