"""Pitman-Yor scores: base figures against counting, probabilities that sum to one, gain over unigrams."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF001, SF01
from wakeline.llm.lm_score import CONTEXTS, STATE, Bucket, LmParams, gather_corpus, op7_pitman_yor_lm, score_corpus, seat, train


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def base(rows):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    count = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(count.values()), len(count)
    return {(i, t): (held[i], len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
                     sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows}


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_base_figures_and_gain(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    want = {i: x for (i, _), x in base(rows).items()}
    got = {r.doc_id: r for r in op7_pitman_yor_lm(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[i][:4]
        assert r.base_score == pytest.approx(want[i][4], rel=1e-9)
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)  # a better log probability


@pytest.mark.parametrize("width", ["8", "200"])
def test_next_words_sum_to_one(spark, width):
    """p(w) over the vocabulary and one unknown word, and p(w|u) over it for any context; also with hot words and cells."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        docs = spark.read.parquet(f"{SF001}/documents.parquet")
        gathered, hot, _ = gather_corpus(docs)
        params = LmParams()
        buckets = gathered.where("kind = 1")
        t = train(buckets, hot, params)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert (len(hot.cell_word) > 0) == (width == "200")
    s, k, p = params.strength, params.sweeps, {}
    seen = np.zeros(CONTEXTS)  # customers less discounts, by context
    for r in buckets.collect():
        b = Bucket(r.bucket, {c: pa.py_buffer(bytes(r[c])) for c in STATE}, t, params)
        while b.sweep < k:
            b.reseat()
        parent = b.parent(t.root_tables[k])
        hot_words = b.word_hot >= 0
        p.update(zip(b.word_hot[hot_words].tolist(), parent[hot_words].tolist()))  # a hot word is in many buckets
        known = (b.word_count > 0) & ~hot_words
        p[f"bucket {r.bucket}"] = float(parent[known].sum())
        seen += np.bincount(b.context[b.several], weights=b.count[b.several] - t.discount * b.tables, minlength=CONTEXTS)
        seen += (1 - t.discount) * b.single_by_context
    seen += np.bincount(hot.cell_context, weights=t.hot_cell_count - t.discount * t.hot_cell_tables[k], minlength=CONTEXTS)
    unknown = (s + t.root_discount * t.root_tables[k]) / (t.vocabulary + 1) / (s + t.tables[k].sum())
    assert sum(p.values()) + unknown == pytest.approx(1, abs=1e-9)
    # sum over w of p(w|u) = (customers less discounts + strength and discounts) / (strength + customers)
    total = (seen + s + t.discount * t.tables[k]) / (s + t.context_count)
    assert np.allclose(total, 1, atol=1e-9)


def test_hot_words_and_cells_score_alike(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 300")
    got = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for width in ("8", "300"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            got.append({r.doc_id: r for r in score_corpus(docs).collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    one, many = got
    for i, r in one.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (many[i].n_tokens, many[i].n_known, many[i].train_tokens)
        assert r.base_score == pytest.approx(many[i].base_score, rel=1e-9)
        assert r.score == pytest.approx(many[i].score, rel=0.05)  # another random seating
    assert sum(r.score for r in one.values()) == pytest.approx(sum(r.score for r in many.values()), rel=0.003)


def test_seating_has_the_chinese_restaurant_mean():
    """Tables of one dish with its own restaurant: a Pitman-Yor process with a known expectation."""
    d, s, n = 0.5, 1.0, 200
    tables = seat(np.full(4000, n), s, d, 1.0, np.random.default_rng(1))
    expected, t = 1.0, 1.0
    for i in range(1, n):
        t += (s + d * t) / (s + i)
    expected = t
    assert tables.mean() == pytest.approx(expected, rel=0.03)
    assert seat(np.array([0, 1, 2]), s, d, 1e-9, np.random.default_rng(1)).tolist() == [0, 1, 1]
    many = seat(np.full(300, 20_000), s, d, 1.0, np.random.default_rng(2)).mean()
    t = 1.0
    for i in range(1, 20_000):
        t += (s + d * t) / (s + i)
    assert many == pytest.approx(t, rel=0.05)  # seated in blocks


def stirling_weights(n, strength, d, parent):
    """Exact weights of 1..n tables: the recursion in logarithms, for any number of customers."""
    log_s = np.zeros(1)
    for i in range(1, n):
        own = log_s + np.log(i - d * np.arange(1, i + 1))
        log_s = np.concatenate([own[:1], np.logaddexp(own[1:], log_s[:-1]), log_s[-1:]])
    log_w = log_s + np.cumsum(np.log(strength + d * np.arange(n)) + np.log(parent))
    w = np.exp(log_w - log_w.max())
    return w / w.sum()


def partitions(n):
    """All set partitions of n customers, as lists of table sizes."""
    out = [[]]
    for _ in range(n):
        out = [x[:k] + [x[k] + 1] + x[k + 1:] for x in out for k in range(len(x))] + [x + [1] for x in out]
    return out


def test_stirling_weights_are_those_of_all_seatings():
    n, s, d, p = 6, 3.0, 0.4, 0.05
    w = np.zeros(n)
    for sizes in partitions(n):
        w[len(sizes) - 1] += math.prod((s + d * j) * p for j in range(len(sizes))) * math.prod(i - d for m in sizes for i in range(1, m))
    assert np.allclose(w / w.sum(), stirling_weights(n, s, d, p))


@pytest.mark.parametrize("strength, d, parent", [(500.0, 0.7, 0.002), (3.0, 0.3, 0.05), (40.0, 0.9, 1e-4), (1.0, 0.5, 0.5), (2000.0, 0.6, 0.3), (9.0, 0.05, 0.1)])
def test_tables_follow_their_conditional_distribution(strength, d, parent):
    """A rare dish: its tables given all others, against the exact distribution; also past the recursion's bound."""
    k = np.arange(1, 3001)
    for n in (2, 5, 20, 256, 257, 600, 3000):
        w = stirling_weights(n, strength, d, parent)
        mean = (w * k[:n]).sum()
        spread = math.sqrt(max((w * (k[:n] - mean) ** 2).sum(), 1e-9))
        draws = seat(np.full(4000, n), strength, d, parent, np.random.default_rng(n))
        assert abs(draws.mean() - mean) < 4.5 * spread / math.sqrt(4000) + 0.002 * mean, (n, draws.mean(), mean)
        assert draws.std() == pytest.approx(spread, rel=0.08, abs=0.03), n


def test_runs_repeat(spark):
    one, two = ({r.doc_id: r.score for r in op7_pitman_yor_lm(spark, SF001).collect()} for _ in range(2))
    assert all(one[i] == pytest.approx(two[i], rel=1e-9) for i in one)


def test_edges(spark, edge_docs, wide_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = score_corpus(edge_docs).collect()
    assert len(got) == len(rows)
    want = base(rows)
    n = [r for r in got if r.doc_id is None]
    assert len(n) == 2 and not any(r.held_out for r in n)
    assert {r.n_tokens for r in got if r.doc_id in (0, 1, 2)} == {1}
    assert {r.train_tokens for r in got} == {next(iter(want.values()))[3]}
    assert sorted((str(r.doc_id), r.n_tokens) for r in score_corpus(wide_docs).collect()) == sorted((str(r.doc_id), r.n_tokens) for r in got)
    assert score_corpus(no_docs).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = score_corpus(spark.createDataFrame([(held, "nothing learned")], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens) for r in alone] == [(0, 0)] and math.isfinite(alone[0].score)


def test_a_scoring_task_holds_a_document_once():
    """Sums of many buckets take the room of their documents, not of buckets times documents."""
    import numpy as np

    from wakeline.llm.lm_score import _Sums

    rng, sums, want = np.random.default_rng(5), _Sums(), np.zeros((4, 1000))
    for _ in range(20):
        row = np.sort(rng.choice(1000, 600, replace=False))
        values = [rng.integers(0, 9, 600).astype(float) for _ in range(4)]
        sums.add(row, *values)
        want[:, row] += values
        assert sums.size() <= 1000
    got = [b.to_pydict() for b in sums.flush()]
    assert sums.size() == 0 and len(got) == 1 and got[0]["row"] == list(range(1000))
    assert np.array_equal([got[0][c] for c in sums.NAMES], want)
