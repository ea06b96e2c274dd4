"""Spaced seeds find all allowed overlaps; leaks against a brute-force diagonal search."""

from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa

from tests.conftest import SF001
from wakeline.llm.decontam import MASKS, NOT_TOKEN, SHORT, WINDOW, allowed, find_leaks, op2_spaced_seed_leaks
from wakeline.llm.tokens import words_of


def test_masks_reach_every_allowed_overlap():
    """For each length and each choice of substituted tokens, some mask fits somewhere on equal tokens."""
    for n in range(SHORT, WINDOW + 1):
        for wrong in combinations(range(n), allowed(n)):
            assert any(all(m[k] == "0" or start + k not in wrong for k in range(len(m)))
                       for m in MASKS for start in range(n - len(m) + 1)), (n, wrong)


def brute(documents, items):
    tokens = lambda text: words_of(pa.array([text], pa.string()), NOT_TOKEN).hash
    items = {k: tokens(t) for k, t in items}
    found = set()
    for doc_id, text in documents:
        d = tokens(text)
        for item_id, item in items.items():
            size = min(WINDOW, len(item))
            if not size or not np.isin(item, d).any():
                continue
            for shift in range(-len(item) + 1, len(d)):
                lo, hi = max(0, shift), min(len(d), shift + len(item))
                same = d[lo:hi] == item[lo - shift:hi - shift]
                if len(same) >= size and (np.convolve(same, np.ones(size, int), "valid") >= size - allowed(size)).any():
                    found.add((doc_id, item_id))
                    break
    return found


def test_query_against_brute_force(spark):
    documents = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet' where length(text) < 3000").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF001}/benchmark.parquet'").fetchall()
    short = {d[0] for d in documents}
    got = {(r.doc_id, r.item_id) for r in op2_spaced_seed_leaks(spark, SF001).collect() if r.doc_id in short}
    assert got == brute(documents, items)
    assert got


def test_substitutions_and_short_items(spark):
    item = " ".join(f"word{i}" for i in range(20))
    near = item.replace("word5 ", "other ").replace("word9 ", "thing ")
    far = " ".join("no" if i % 3 == 0 else f"word{i}" for i in range(20))
    docs = [(1, "start " + item + " end"), (2, "a b " + near.upper()), (3, far), (4, "what is love"), (5, "what is, LOVE? yes"), (6, "what is hate")]
    bench = [(10, item), (11, "What is love?"), (12, None), (13, ""), (10, item)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.first_word, r.end_word, r.n_equal) for r in got.collect()) == [
        (1, 10, 1, 21, 20), (2, 10, 2, 22, 18), (4, 11, 0, 3, 3), (5, 11, 0, 3, 3)]


def test_edges(spark, edge_docs, wide_docs, no_docs):
    bench = spark.createDataFrame([(1, "w1é w2é w3é w4é w5é w6é w7é w8é w9é w10é w11é w12é w13é"), (None, "one two three four")], "item_id long, text string")
    rows = lambda docs: sorted((r.doc_id, r.item_id) for r in find_leaks(docs, bench.withColumn("row", bench.item_id)).collect() if r.item_id)
    assert rows(edge_docs) == rows(wide_docs) == [(9, 1)]
    assert find_leaks(no_docs, bench).count() == 0
    assert find_leaks(edge_docs, bench.where("false")).count() == 0
