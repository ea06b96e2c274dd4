"""Personal data: base rules against plain expressions, proposals, trees and thresholds."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.conftest import SF01
from wakeline.llm.pii import KINDS, PiiParams, _listed, _running, find_pii, find_spans, op13_boosted_pii, redact, threshold, tree_sql

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def found_base(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(s.start, s.kind, s.end) for s in r.base] for r in find_spans(docs).select("doc_id", "base").collect()}


ODD = [
    "a@b.c_d@e.f", "a@b.c.d@e.f @x.y a@@b.c a@b a@b. a@b..c", "x.y+z%1@m-1.example.co.uk.", "é@x.com ü1@x.comé", "a@b.c@d.e.f",
    "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 0001.02.3.4 1.2.3", "00000000000000255.0.0.000000256", "1.2.3.4-5.6.7.8",
    "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111 x4111  1111", "4111111111111111 4111111111111111",
    "0 4111111111111111", "4111111111111112", "5500-0055-5555-5559.", "é4111111111111111é😀 4111111111111111x", "1-4111111111111111",
    "+1 (017) 555-7713", "+1 (826) 555-4081 190.137.223.204", "++1234567890", "+1-", "+1 23", "+12 34 5678 901 .", "+1(2)3.4-5 6 7 8 9 0)))",
    None, "", " ", "+", "@", "0", "😀+49 30 1234567 é a.b@c.de",
]


def test_base_rules_on_odd_texts(spark):
    assert found_base(spark, ODD) == {i: base(t) for i, t in enumerate(ODD)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789014 .-+()@aZ_é😀", max_size=80), min_size=40, max_size=80))
def test_base_rules_on_random_texts(spark, texts):
    assert found_base(spark, texts) == {i: base(t) for i, t in enumerate(texts)}


def test_base_rules_on_a_table(spark):
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op13_boosted_pii(spark, SF01).collect()}
    for r in rows:
        want = base(r.text)
        g = got.pop(r.doc_id)
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(s[1] == k for s in want) for k in range(4))
        listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert g.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(g.spans.split(","))
    assert not got


@pytest.mark.parametrize("text", ["1" * 300_000, "x" * 300_000, "x@" + "y" * 300_000, "1 " * 100_000, "+1" + " " * 300_000,
                                  "a." * 100_000 + "@b", "(" * 200_000])
def test_long_runs_without_spans(spark, text):
    """Matching stays linear (the plain expressions would not) and does not nest calls."""
    assert found_base(spark, [text]) == {0: []}


def test_long_run_of_addresses(spark):
    assert found_base(spark, ["1." * 40_000]) == {0: [(8 * k, 1, 8 * k + 7) for k in range(10_000)]}


def test_many_matches(spark):
    text = "é a@b.cd 1.2.3.4 " * 3_000
    assert found_base(spark, [text]) == {0: base(text)}


def test_running_sums(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        got = spark.range(1).select(F.expr(_running(f"transform(slice(sequence(0, {n}), 1, {n}), i -> i * 3L)")).alias("o")).first().o
        want, total = [], 0
        for i in range(n):
            want.append(total)
            total += 3 * i
        assert got == want


def planted(n):
    """Texts with plain cards and phones, numbers that are neither, and spans that the base rules miss."""
    rng, rows, hidden = random.Random(5), [], {}

    def card():
        d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if luhn(d + c))

    def wrong():
        c = card()
        return c[:-1] + str((int(c[-1]) + 1 + rng.randrange(9)) % 10)

    def phone():
        return f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"

    for i in range(n):
        kind = i % 5
        words = " ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(20))
        text = {0: f"{words} {card()} {words}", 1: f"{words} {phone()} {words}", 2: f"{words} {wrong()} id 1.22.333 {words}",
                3: f"{words} {rng.randrange(1000)} {words} 12-34", 4: words}[kind]
        if i % 100 == 0:
            a, b = card(), card()
            hidden[i] = [f"card:{len(words) + 1}:{len(words) + 17}", f"card:{len(words) + 18}:{len(words) + 34}"]
            text = f"{words} {a} {b} {words}"
        elif i % 100 == 1:
            p = phone()
            hidden[i] = [f"phone:{len(words) + 1}:{len(words) + 1 + len(p)}"]
            text = f"{words} {p} 123456789 {words}"
        rows.append((i, text))
    return rows, hidden


def test_hidden_spans_are_added_and_others_not(spark):
    rows, hidden = planted(1000)
    spans = find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.expr(_listed("spans")).alias("s"), F.expr(_listed("base")).alias("b"))
    got = {r.doc_id: (r.s, r.b) for r in spans.collect()}
    for i, text in rows:
        want = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base(text)]
        assert got[i] == (",".join(want + hidden.get(i, [])), ",".join(want)), text


def test_trees_as_sql_equal_the_model(spark):
    rng = random.Random(3)
    rows = [(*(rng.choice([0.0, 1.5, -2.25, 7.0]) for _ in range(4)),) for _ in range(400)]
    rows = [(*r, float(r[0] > 1 and r[2] < 0 or rng.random() < 0.1)) for r in rows]
    x = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="x").transform(spark.createDataFrame(rows, "a double, b double, c double, d double, y double"))
    model = GBTClassifier(maxIter=8, maxDepth=3, seed=1, labelCol="y", featuresCol="x").fit(x)
    margin = " + ".join(f"({w!r}D) * {tree_sql(t.toDebugString, 'f')}" for w, t in zip(model.treeWeights, model.trees))
    from pyspark.ml.functions import vector_to_array

    both = model.transform(x).select(vector_to_array("probability")[1].alias("p"), F.array("a", "b", "c", "d").alias("f")).select(
        "p", F.expr(f"1D / (1D + exp(-2D * ({margin})))").alias("q"))
    assert all(abs(r.p - r.q) < 1e-12 for r in both.collect())


def test_threshold():
    assert threshold([(0.9, 1.0)] * 10, 0.8) == 0.9
    assert threshold([(0.9, 1.0)] * 2, 0.8) is None  # too few to tell
    assert threshold([(0.9, 1.0)] * 10 + [(0.7, 1.0)] * 3 + [(0.6, 0.0)] * 9, 0.8) == 0.7
    assert threshold([(0.9, 1.0)] * 10 + [(0.9, 0.0)] * 10, 0.8) is None  # equal scores go together
    assert threshold([(0.4, 1.0)] * 10, 0.8) is None
    assert threshold([], 0.8) is None


def test_edges(spark, edge_docs, wide_docs, no_docs):
    rows = find_pii(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert sorted(map(str, find_pii(wide_docs).collect())) == sorted(map(str, rows))
    assert find_pii(no_docs).count() == 0
    assert find_spans(no_docs).count() == 0


def test_one_kind_of_label_adds_nothing(spark):
    docs = spark.createDataFrame([(i, f"x {4111111111111112 + 10 * i} y") for i in range(50)], "doc_id long, text string")
    got = find_pii(docs.where("text rlike '(?!)'").unionByName(docs), PiiParams()).collect()
    assert all(r.spans == r.base for r in got if not r.spans) and len(got) == 50


def test_redact(spark):
    rows = [(1, "é mail a@b.cd, ip 1.2.3.4 end"), (2, None), (3, "nothing"), (3, "+1 (017) 555-7713"), (None, "4111111111111111x@y.zz.")]
    got = sorted((str(r.doc_id), str(r.text)) for r in redact(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("1", "é mail <email>, ip <ip> end"), ("2", "None"), ("3", "nothing"), ("3", "<phone>"), ("None", "<email>.")])


def test_trees_and_thresholds_take_in_every_proposal(spark, monkeypatch):
    """What is fitted and calibrated adds up to all different proposals, far more than the 20,000 of a former sample."""
    import wakeline.llm.pii as pii

    n, weights = 30_000, {}
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("tel +1 "), F.format_string("(%03d) 555-%04d", F.floor(F.col("id") / 10_000) + 200, F.col("id") % 10_000),
                                                                       F.lit(" id "), F.col("id") + 1_000_000_000_000_000).alias("text"))
    found = pii.stored(find_spans(docs), "pii-all")
    want = found.select(F.explode("proposals").alias("c")).select("c.kind", "c.match").distinct().count()

    class Counted(GBTClassifier):
        def fit(self, data):
            weights["fitted"] = data.agg(F.sum("n")).first()[0]
            return super().fit(data)

    calibrate = pii.calibrate
    monkeypatch.setattr(pii, "GBTClassifier", Counted)
    monkeypatch.setattr(pii, "calibrate", lambda judged, least: weights.update(held=judged.agg(F.sum("n")).first()[0]) or calibrate(judged, least))
    pii.fit_spans(found, PiiParams(trees=2))
    assert want > 2 * n - 10 and weights["fitted"] + weights["held"] == want
    assert 0.3 < weights["held"] / want < 0.37


def test_thresholds_are_those_of_all_held_out_scores(spark):
    from wakeline.llm.pii import calibrate

    rng = random.Random(11)
    rows = [(rng.randrange(3), float(rng.random() < 0.85), float(rng.randrange(1, 4)), rng.randrange(100) / 100) for _ in range(2000)]
    got = calibrate(spark.createDataFrame(rows, "kind int, label double, n double, p double"), 0.8)
    assert got == tuple(threshold([(p, y) for k, y, n, p in rows if k == kind for _ in range(int(n))], 0.8) for kind in range(len(KINDS)))
