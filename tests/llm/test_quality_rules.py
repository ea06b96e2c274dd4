"""Rule metrics against plain Python, on real and odd texts."""

import random
import re

import duckdb

from tests.conftest import SF001
from wakeline.llm.quality_rules import RULES, Rule, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(words) < 400 else None
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), covered and len(covered)


def test_counts(spark):
    rng = random.Random(4)
    rows = [r for r in duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall() if len(r[1].split()) < 400]
    rows += [(10_000 + i, "".join(rng.choice(["a", "b", " ", " ", "\n", "c d", "#", "\x0b", "é", "\u00a0"]) for _ in range(rng.randint(0, 80)))) for i in range(300)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r, (_, text) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows)):
        want = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (*want[:4], want[4] or 0)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_rules_are_a_table(spark, edge_docs):
    text = " ".join(f"word{i} the" for i in range(40)) + " ###"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules(docs).first().kept
    assert quality_rules(docs, [*RULES, Rule("symbols_per_word", high=0.01)]).first().failed_rules == ["symbols_per_word"]
    assert quality_rules(docs, [Rule("n_words", low=100)]).first().kept is False


def test_edges(spark, edge_docs, wide_docs, no_docs):
    rows = quality_rules(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert sorted(map(str, quality_rules(wide_docs).collect())) == sorted(map(str, rows))
    assert quality_rules(no_docs).count() == 0


def test_one_stage_without_python(spark, edge_docs):
    plan = quality_rules(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
