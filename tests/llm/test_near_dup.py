"""Dart signatures estimate weighted similarity; classes equal those of all pairs."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.conftest import SF001, SF01
from wakeline.llm.components import components
from wakeline.llm.near_dup import NearDupParams, dart_signatures, near_duplicate_classes, op9_dart_minhash


@pytest.mark.parametrize("n", [1, 5, 400, 5000])
def test_signatures_agree_with_the_weighted_similarity(n):
    rng = np.random.default_rng(n)
    t, trials = 64, 40
    hits, want = 0, 0.0
    for _ in range(trials):
        element = rng.integers(0, 2**63, n, dtype=np.uint64)
        a, b = rng.uniform(0, 3, n) + 0.01, rng.uniform(0, 3, n) + 0.01
        row = np.repeat([0, 1], n)
        s = dart_signatures(row, np.concatenate([element, element]), np.concatenate([a, b]), 2, t)
        hits += (s[0] == s[1]).sum()
        want += t * np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(hits - want) < 4 * np.sqrt(t * trials) * 0.5


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (3, 9), (20, 10), *((100, k) for k in range(101, 140))]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 10: 10, 11: 10, 20: 10, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows, weighted=True):
    parent = {i: i for i, _ in rows}

    def head(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def link(a, b):
        a, b = sorted((head(a), head(b)))
        parent[b] = a

    by_text = defaultdict(list)
    for i, t in sorted(rows):
        by_text[t or ""].append(i)
    sets = {}
    for text, ids in by_text.items():
        for i in ids:
            link(ids[0], i)
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        if w:
            counts = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
            sets[ids[0]] = counts if weighted else Counter(dict.fromkeys(counts, 1))
    having = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            having[g].append(i)
    for a, b in {(x, y) for ids in having.values() for x in ids for y in ids if x < y}:
        both = (sets[a] & sets[b]).total()
        if both >= 0.8 * (sets[a].total() + sets[b].total() - both):
            link(a, b)
    return {i: head(i) for i, _ in rows}


@pytest.mark.parametrize("params", [NearDupParams(), NearDupParams(pivot_rounds=0, block_texts=2), NearDupParams(pivot_rounds=1, block_texts=3),
                                    NearDupParams(weighted=False), NearDupParams(weighted=False, pivot_rounds=0, block_texts=2)])
def test_classes_against_all_pairs(spark, params):
    rows = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    base = [f"w{i}" for i in range(120)]
    for k in range(40):  # a group of near copies, some too far from each other
        words = base[:]
        for j in range(k % 7):
            words[(k * 13 + j * 29) % 120] = f"x{k}{j}"
        words += ["again and again we say"] * (k % 5 * 4)  # shingles in other numbers
        rows.append((1000 + k, " ".join(words)))
    got = near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows, params.weighted)


def test_query_against_all_pairs(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    assert {r.doc_id: r.class_id for r in op9_dart_minhash(spark, SF01).collect()} == brute(rows)


def test_weighted(spark):
    a = " ".join(["one two three four five"] * 9 + [f"t{i}" for i in range(20)])
    b = " ".join(["one two three four five"] * 3 + [f"t{i}" for i in range(20)])
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    classes = lambda p: {r.class_id for r in near_duplicate_classes(docs, p).collect()}
    assert classes(NearDupParams(weighted=False)) == {1}  # the same shingles
    assert classes(NearDupParams()) == {1, 2}  # in other numbers


def test_edges(spark, edge_docs, wide_docs, no_docs):
    got = near_duplicate_classes(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = defaultdict(set)
    for r in got:
        by[r.class_id].add(r.doc_id)
    assert {None, 0, 1} in by.values()                # null is the empty text
    assert {None, 5, 6, 7} in by.values()             # copies, a null doc_id, a near copy
    assert {3} in by.values() and {4} in by.values() and {2} in by.values()
    shown = lambda df: sorted(str((r.doc_id, r.class_id, r.class_texts)) for r in df.collect())
    assert shown(near_duplicate_classes(wide_docs)) == shown(near_duplicate_classes(edge_docs))
    assert near_duplicate_classes(no_docs).count() == 0
