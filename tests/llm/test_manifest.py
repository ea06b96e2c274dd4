"""Merkle manifest: postorder places, trees and proofs against a plain level-by-level build."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wakeline.llm.manifest import Shape, append_log, height, log_positions, manifest, postorder, verify_rows

SMALL = Shape(arity=2, block_levels=2)


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_levels(leaves, arity):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[k:k + arity])) for k in range(0, len(row), arity)])
    return levels


def plain_siblings(levels, i, arity):
    out = []
    for row in levels[:-1]:
        lo = i - i % arity
        run = row[lo:lo + arity]
        out.append((run[: i - lo], run[i - lo + 1:]))
        i //= arity
    return out


@pytest.mark.parametrize("arity", [2, 3, 8])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 27, 63, 64, 65, 100])
def test_log_is_in_postorder(arity, n):
    """The places by closed form are those of the log, and every node stands after its children."""
    leaves = [str(i) for i in range(n)]
    top = height(n, arity)
    log = append_log(leaves, top, arity)
    assert [postorder(level, k, n, top, arity) for level, k, _ in log] == list(range(len(log)))
    levels = plain_levels(leaves, arity)
    assert {(level, k): v for level, k, v in log} == {(level, k): v for level, row in enumerate(levels) for k, v in enumerate(row)}


def leaf(r, text=...):
    values = [r.doc_id, r.source, r.lang, r.n_chars, r.text if text is ... else text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows, arity, changed=lambda r: False):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, order = {}, {}
    for g in names:
        order[g] = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[g] = plain_levels([leaf(r) for r in order[g]], arity)
    top = plain_levels([trees[g][-1][0] for g in names], arity)
    root, out = top[-1][0], []
    for j, g in enumerate(names):
        above = plain_siblings(top, j, arity)
        for i, r in enumerate(order[g]):
            path = plain_siblings(trees[g], i, arity) + above
            low = r.text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
            cur = leaf(r, low) if changed(r) else leaf(r)
            for lo, hi in path:
                cur = h("".join(lo) + cur + "".join(hi))
            out.append((r.doc_id, leaf(r), trees[g][-1][0], root, h("".join("".join(lo + hi) for lo, hi in path)), cur, cur == root))
    return sorted(map(str, out))


def result(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("shape", [Shape(), SMALL, Shape(3, 1)])
def test_odd_rows(spark, edge_docs, wide_docs, shape):
    want = brute(edge_docs.collect(), shape.arity)
    assert result(verify_rows(edge_docs, shape=shape)) == want
    assert result(verify_rows(wide_docs, shape=shape)) == want


@pytest.mark.parametrize("shape", [Shape(), Shape(8, 1), SMALL])
def test_groups_of_many_sizes(spark, shape):
    """Trees of one to several rounds beside each other, and more languages than a run."""
    rows = [(k, f"Text {k}", f"l{g}" if g else None, f"s{k % 7}", k % 5 or None)
            for g, n in enumerate([1, 2, 8, 9, 64, 65, 130, 3, 1, 600]) for k in range(g * 1000, g * 1000 + n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    changed = lambda r: zlib.crc32(str(r.doc_id).encode()) % 3 == 0
    got = verify_rows(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lower("text"), shape)
    assert result(got) == brute(docs.collect(), shape.arity, changed)
    assert got.where("verified").count() == sum(not changed(r) for r in docs.collect())


@pytest.mark.parametrize("shape", [Shape(8, 1), SMALL])
def test_log_table(spark, shape):
    """Positions in a group's log are gapless and in completion order over all rounds."""
    docs = spark.createDataFrame([(k, "t", "en" if k < 77 else "de") for k in range(100)], "doc_id long, text string, lang string")
    docs = docs.select("*", F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars"))
    m = manifest(docs, shape)
    got = {}
    for r in log_positions(m.trees).collect():
        got.setdefault(r.grp, {})[r.pos] = (r["level"], r["index"], r["digest"])
    leaves = {}
    for r in m.leaves.collect():
        leaves.setdefault(r.grp, {})[r["index"]] = r["digest"]
    assert sorted(got) == ["1de", "1en"]
    for g, log in got.items():
        row = [leaves[g][k] for k in range(len(leaves[g]))]
        assert [log[k] for k in range(len(log))] == append_log(row, height(len(row), shape.arity), shape.arity)


def test_empty_table(spark, no_docs):
    assert verify_rows(no_docs).count() == 0
    assert manifest(no_docs).root is None
