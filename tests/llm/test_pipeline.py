"""The corpus pipeline: each stage judged on its own input, empty input included."""

import re
from collections import Counter

import duckdb

import corpus_pipeline
from tests.conftest import SF001, SF01
from tests.llm.conftest import CLASHING, DOC_COLUMNS
from tests.llm.test_bpe import whole
from tests.llm.test_decontam import brute as brute_leaks
from tests.llm.test_near_dup import brute as brute_classes
from tests.llm.test_suffix_dedup import brute as brute_repeats
from wakeline.llm.bpe import Encoder, unpack, vocabulary_path
from wakeline.llm.tables import stored


def stages_of(spark, sf_dir):
    """The documents before each stage, then the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == [c.split()[0] for c in DOC_COLUMNS.split(", ")]
    return seen


def test_each_stage_on_its_input(spark):
    start, good, single, cut, clean, encoded = stages_of(spark, SF01)
    texts = lambda rows: {r.doc_id: r.text for r in rows}
    insults = set("trash pathetic idiot worthless disgusting stupid clown scum loser moron".split())
    toxic = {r.doc_id for r in start if insults & set(re.findall("[a-z]+", r.text.lower()))}
    kept = texts(good)
    assert len(toxic & kept.keys()) <= 0.05 * len(toxic)
    labels = dict((i, (q, t)) for i, q, t in duckdb.sql(f"select doc_id, quality, toxic from '{SF01}/labels.parquet'").fetchall())
    fine = {i for i, x in labels.items() if x == (1, 0)} - toxic
    assert len(fine & kept.keys()) >= 0.98 * len(fine)
    classes = brute_classes(list(kept.items()))
    assert texts(single).keys() == set(classes.values())
    want = {r[0]: r[4].decode("utf-8", "ignore") for r in brute_repeats(list(texts(single).items()), 100)}
    assert texts(cut) == want and all(r.n_chars == len(r.text) for r in cut)
    items = duckdb.sql(f"select item_id, text from '{SF01}/benchmark.parquet'").fetchall()
    short = {i: t for i, t in texts(cut).items() if len(t) < 2500}
    leaky = {i for i, _ in brute_leaks(list(short.items()), items)}
    assert texts(clean).keys() & short.keys() == short.keys() - leaky
    enc = Encoder(vocabulary_path())
    assert {r.doc_id: unpack(r.ids).tolist() for r in encoded} == {i: whole(enc, t) for i, t in texts(clean).items()}
    assert all(r.n_tokens * 4 == len(r.ids) and enc.decode(unpack(r.ids).tolist()) == r.decoded for r in encoded)


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, SF001)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in stages_of(spark, SF001)[-1])


def test_edges(spark, edge_docs, wide_docs, no_docs):
    """Odd rows, clashing names and no rows: every stage keeps all columns of documents and adds no document."""
    for start in (no_docs, edge_docs, wide_docs):
        docs, left = start, Counter(r.doc_id for r in start.collect())
        for name, stage in corpus_pipeline.STAGES:
            last = name == corpus_pipeline.STAGES[-1][0]
            docs = stored(stage(spark, docs, SF001), "test-edge")
            assert last or docs.columns == start.columns
            assert last or start is not wide_docs or all(r[c] == 7 for r in docs.collect() for c in CLASHING)
            ids = Counter(r.doc_id for r in docs.collect())
            assert ids <= left and (ids == left or not last)  # encoding keeps every document
            left = ids
        assert start is not no_docs or not left
