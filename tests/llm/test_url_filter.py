"""Host rules, URL parts and mined rules on small fixtures."""

import random
from itertools import combinations

import pytest

from wakeline.llm.url_filter import Mining, mine_rules, url_verdicts

PAGES = "page_id long, url string, html string"


def verdicts(spark, urls, labels=(), mining=Mining()):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    found = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return {r.page_id: r for r in url_verdicts(pages, found, mining=mining).collect()}


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://A.Example.NET/en/x?y", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/fr/", "example.net", "/fr/", "net/", "block"),
    ("https://net/", "net", "/", "net/", "block"),
    ("https://net", "net", "", None, "allow"),
    ("https://fishnet/", "fishnet", "/", None, "allow"),
    ("https://x.example.com/de/1#top", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("https://example.com/DE/1", "example.com", "/DE/1", None, "allow"),
    ("ftp://w.org/fr/a://b", "w.org", "/fr/a://b", "org/fr/", "allow"),
    ("//x.net/", "", "", None, "allow"), ("x.net/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("://?q", "", "", None, "allow"), ("http://É.NET?/x", "É.net", "", None, "allow"),
])
def test_host_rules(spark, url, host, path, rule, verdict):
    r = verdicts(spark, [url])[0]
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_mined_rules_block_token_combinations(spark):
    # "bad" with "casino" is bad, either alone is not
    urls = [f"http://h{i}.com/{'bad' if i % 2 else 'good'}/{'casino' if i % 4 >= 2 else 'news'}/{i}" for i in range(400)]
    labels = [(i, 1, 1 if i % 4 == 3 else 0) for i in range(200)]
    got = verdicts(spark, urls, labels)
    assert {i for i, r in got.items() if r.verdict == "block"} == {i for i in range(400) if i % 4 == 3}
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    rules = mine_rules(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert rules and all({"p:bad", "p:casino"} <= set(r.tokens) and r.confidence == 1.0 for r in rules)


def test_rules_of_any_size_block(spark):
    """Pages with all of four parts are bad and no three of them tell; against brute force over all token sets."""
    parts = ["ad", "buy", "click", "deal"]
    rng = random.Random(8)
    urls = ["http://h.com/" + "/".join(p for k, p in enumerate(parts) if i >> k & 1) for i in range(16)] * 30
    bad = [i % 16 == 15 or rng.random() < 0.03 for i in range(len(urls))]
    known = range(len(urls) // 2)
    sets = [frozenset({"h:h", "h:com", *("p:" + p for k, p in enumerate(parts) if i >> k & 1)}) for i in range(16)] * 30
    seen = {}
    for i in known:
        for size in range(1, len(sets[i]) + 1):
            for c in map(frozenset, combinations(sorted(sets[i]), size)):
                n, b = seen.get(c, (0, 0))
                seen[c] = n + 1, b + bad[i]
    rules = [c for c, (n, b) in seen.items() if b >= 10 and b / n >= 0.6]
    assert rules and min(map(len, rules)) == 4
    got = verdicts(spark, urls, [(i, 1, int(bad[i])) for i in known])
    assert {i for i, r in got.items() if r.verdict == "block"} == {i for i, s in enumerate(sets) if any(c <= s for c in rules)}
    assert {i % 16 for i, r in got.items() if r.verdict == "block"} == {15}


def test_too_few_labels_make_no_rule(spark):
    urls = [f"http://h.com/bad/{i}" for i in range(20)]
    assert {r.verdict for r in verdicts(spark, urls, [(i, 0, 1) for i in range(9)]).values()} == {"allow"}
    assert {r.verdict for r in verdicts(spark, urls, [(i, 0, 1) for i in range(10)]).values()} == {"block"}


def test_edges(spark):
    labels = [(0, 0, None), (0, 1, 0), (None, 0, 1), (1, None, None)]
    got = verdicts(spark, ["http://a.com/x", "http://a.com/x", None], labels, Mining(min_pages=1, min_confidence=0.4))
    assert [got[i].verdict for i in range(3)] == ["block", "block", "allow"]
    pages = spark.createDataFrame([(1, "http://n.net/", "h"), (1, "http://n.net/", "h"), (None, None, None)], PAGES)
    from pyspark.sql import functions as F

    wide = pages.select("*", *(F.lit(1).alias(c) for c in ("tokens", "_token", "host", "path", "rule", "verdict", "items", "doc_id")))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(map(str, url_verdicts(wide, none).collect())) == sorted(map(str, url_verdicts(pages, none).collect()))
    assert url_verdicts(pages, none).count() == 3
    assert url_verdicts(pages.where("false"), none).count() == 0
