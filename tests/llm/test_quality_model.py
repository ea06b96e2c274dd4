"""Ordinal regression: thresholds in order, held-out quality, whole texts, odd rows."""

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wakeline.llm.quality_model import FitParams, document_features, fit, fit_ordinal, loss_and_gradient, score_documents

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = labels.where("doc_id % 3 <> 0")
    model = fit(docs, train)
    assert np.all(np.diff(model.thresholds) > 0)
    rows = score_documents(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").select(
        "text", "quality", "toxic", "kept", "expected_grade", "tail_probability").collect()
    insults = set("trash pathetic idiot worthless disgusting stupid clown scum loser moron".split())
    toxic = lambda r: r.toxic == 1 and bool(insults & set(re.findall("[a-z]+", r.text.lower())))  # noqa: E731  labels are noisy
    bad = [r for r in rows if toxic(r)]
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r for r in rows if r.quality == 0 and r.toxic == 0]
    assert np.mean([r.kept for r in bad]) < 0.05
    assert np.mean([r.kept for r in clean]) > 0.98
    assert np.mean([r.kept for r in junk]) < 0.15
    mean = lambda rs: np.mean([r.expected_grade for r in rs])
    assert mean(bad) < mean(junk) < mean(clean)


def test_learns_graded_words():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 3, 600)
    row = np.arange(600)
    m = fit_ordinal(row, (grade + 10).astype(np.uint64), grade, FitParams(min_z=2))
    p = m.grade_probabilities(m.scores(row, (grade + 10).astype(np.uint64), 600))
    assert (p.argmax(1) == grade).mean() > 0.99 and np.allclose(p.sum(1), 1)


def plain_loss(p, docs, grade, weight, l2):
    """The likelihood written out document by document."""
    m = len(p) - 2
    cuts = [p[m], p[m] + math.exp(p[m + 1])]
    below = lambda k, s: 0.0 if k < 0 else 1.0 if k == 2 else 1 / (1 + math.exp(s - cuts[k]))
    loss = sum(l2 / 2 * x * x for x in p[:m])
    for words, g, w in zip(docs, grade, weight):
        s = sum(p[k] for k in words)
        loss -= w * math.log(below(g, s) - below(g - 1, s))
    return loss


def test_likelihood_and_gradient():
    rng = random.Random(2)
    docs = [rng.sample(range(6), rng.randint(0, 6)) for _ in range(40)]
    grade, weight = [rng.randrange(3) for _ in docs], [rng.uniform(0.1, 3) for _ in docs]
    rows = np.repeat(np.arange(40), [len(d) for d in docs])
    cols = np.array([k for d in docs for k in d])
    for _ in range(5):
        p = np.array([rng.gauss(0, 1) for _ in range(8)])
        value, gradient = loss_and_gradient(p, rows, cols, np.array(grade), np.array(weight), 0.3)
        assert math.isclose(value, plain_loss(p, docs, grade, weight, 0.3), rel_tol=1e-9)
        for k in range(8):
            step = np.eye(8)[k] * 1e-6
            slope = (plain_loss(p + step, docs, grade, weight, 0.3) - plain_loss(p - step, docs, grade, weight, 0.3)) / 2e-6
            assert math.isclose(gradient[k], slope, rel_tol=1e-4, abs_tol=1e-5)


def test_fit_is_a_minimum_and_tails_are_those_of_the_model():
    rng = np.random.default_rng(3)
    grade = rng.integers(0, 3, 900)
    row = np.repeat(np.arange(900), 2)
    word = np.stack([grade + 10 + (rng.random(900) < 0.3), rng.integers(50, 60, 900)], axis=1).ravel().astype(np.uint64)
    m = fit_ordinal(row, word, grade, FitParams(min_z=2, rounds=20_000, slope=1e-6))
    at = {int(f): k for k, f in enumerate(m.features)}
    docs = [[at[int(w)] for w in word[2 * i: 2 * i + 2] if int(w) in at] for i in range(900)]
    p = np.concatenate([m.weights, m.thresholds[:1], np.log(np.diff(m.thresholds))])
    best = plain_loss(p, docs, grade, np.ones(900), 0.5)
    for k in range(len(p)):
        for step in (-0.05, 0.05):
            assert plain_loss(p + step * np.eye(len(p))[k], docs, grade, np.ones(900), 0.5) > best
    scores = m.scores(row, word, 900)
    tail = m.grade_probabilities(scores)[:, -1]
    assert np.allclose(tail, [1 - 1 / (1 + math.exp(sum(m.weights[k] for k in d) - m.thresholds[-1])) for d in docs])


def test_a_rare_grade_is_learned(spark):
    """Three in a thousand labels are toxic; their words still get weights."""
    filler = [f"plain{k}" for k in range(40)]
    rng = random.Random(6)

    def text(i):
        words = rng.choices(filler, k=30)
        return " ".join(words + ([f"slur{i // 333 % 5}"] if i % 333 == 0 else ["junk"] if i % 5 == 1 else []))

    rows = [(i, text(i), 0 if i % 5 == 1 else 1, int(i % 333 == 0)) for i in range(20_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = score_documents(table.select("doc_id", "text"), fit(table, table)).collect()
    kept = {r.doc_id: r.kept for r in got}
    toxic = [i for i in range(20_000) if i % 333 == 0]
    clean = [i for i in range(20_000) if i % 333 and i % 5 != 1]
    assert np.mean([kept[i] for i in toxic]) < 0.05 and np.mean([kept[i] for i in clean]) > 0.98


def test_a_word_at_the_very_end_counts():
    _, a = document_features(pa.array(["word " * 50_000]))
    _, b = document_features(pa.array(["word " * 50_000 + "idiot"]))
    assert len(set(b.tolist()) - set(a.tolist())) >= 1


def test_edges(spark, edge_docs, wide_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 1), (6, 1, 0), (9, 0, 0), (None, 1, 0), (7, None, None), (7, None, 0)], "doc_id long, quality int, toxic int")
    model = fit(edge_docs, labels)
    rows = score_documents(edge_docs.select("doc_id", "text"), model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.expected_grade <= 2 for r in rows)
    assert len({r.expected_grade for r in rows if r.doc_id in (0, 1)}) == 1
    assert score_documents(wide_docs, model).count() == len(rows)
    assert score_documents(no_docs, model).count() == 0
    for few in (labels.where("false"), labels.where("doc_id = 6")):
        all_kept = score_documents(edge_docs, fit(edge_docs, few)).agg(F.min("kept").alias("k")).first().k
        assert all_kept is True
    only_bad = fit(edge_docs, labels.where("doc_id = 9"))
    assert score_documents(edge_docs, only_bad).agg(F.max("kept").alias("k")).first().k is False
