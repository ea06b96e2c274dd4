"""Banded alignment against full alignment, and license places against the texts."""

import random

import duckdb
import numpy as np
import pyarrow as pa

from tests.conftest import SF01
from wakeline.llm.license_scan import NAMING, TEMPLATES, TemplateIndex, align, allowed_edits, find_licenses, folded_words, op5_license_scan


def full_alignment(template, text):
    """Least edits of the whole template anywhere in the text, then most equal tokens."""
    best = [(0, 0)] * (len(text) + 1)
    for a in template:
        row = [(best[0][0] + 1, best[0][1])]
        for j, b in enumerate(text):
            step = (best[j][0] + (a != b), best[j][1] - (a == b))
            row.append(min(step, (best[j + 1][0] + 1, best[j + 1][1]), (row[j][0] + 1, row[j][1])))
        best = row
    cost, equal = min(best)
    return cost, -equal


def test_alignment_inside_the_band_is_the_full_one():
    rng = random.Random(2)
    for _ in range(200):
        template = [rng.randrange(6) for _ in range(rng.randint(3, 14))]
        part = [t for t in template if rng.random() > 0.1]
        part = [rng.randrange(6) if rng.random() < 0.1 else t for t in part]
        before = [9] * rng.randint(0, 5)
        text = before + part + [9] * rng.randint(0, 5)
        cost, equal, start, end = align(np.array(template), np.array(text), len(before), band=40)
        assert (cost, equal) == full_alignment(template, text)
        assert 0 <= start <= end <= len(text)


def test_changed_notices_are_found_with_their_spans(spark):
    mit = TEMPLATES["MIT"]
    changed = mit.replace("free of charge", "at no charge").replace("documentation files", "docs")
    docs = [(1, "Intro text.\n" + mit + "\nthe end"), (2, changed), (3, mit[: len(mit) // 2]), (4, "permission is granted, hereby"),
            (5, "LICENSED under the Apache License, version 1.1!"), (6, "Released under the MIT License. Text. Released under the MIT license.")]
    got = find_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    places = sorted((r.doc_id, r.license) for r in got)
    assert places == [(1, "MIT"), (2, "MIT"), (5, "Apache-2.0 notice"), (6, "MIT notice"), (6, "MIT notice")]
    exact = next(r for r in got if r.doc_id == 1)
    assert exact.coverage == 1.0 and docs[0][1].encode()[exact.start_byte:exact.end_byte].decode() == mit.rstrip(".")
    assert 0.9 < next(r for r in got if r.doc_id == 2).coverage < 1


def test_notices_of_the_corpus(spark):
    """Every line of the corpus that is a notice is found, and nothing else."""
    rows = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall()
    marks = {"Apache-2.0 notice": "Licensed under the Apache License", "MIT notice": "Released under the MIT License",
             "GPL notice": "licensed under the GNU General Public License", "CC BY-NC notice": "Licensed under CC BY-NC"}
    want = {(i, name) for i, t in rows for name, mark in marks.items() if mark in t}
    assert {(r.doc_id, r.license) for r in op5_license_scan(spark, SF01).collect()} == want and want


def test_candidates_are_those_of_full_alignment():
    """Every change of a short notice within its edits, one or two at a time, is a candidate of its template."""
    index = TemplateIndex(TEMPLATES)
    rng = random.Random(5)
    for t, name in enumerate(index.names):
        m = len(index.tokens[t])
        if m > 13:
            continue
        words = "".join(c if c.isalnum() else " " for c in TEMPLATES[name]).split()
        changed = {" ".join(words)}
        for _ in range(allowed_edits(m)):
            more = set()
            for text in changed if len(changed) < 60 else rng.sample(sorted(changed), 60):
                w = text.split()
                more.update(" ".join(w[:i] + part + w[i + cut:]) for i in range(len(w) + 1) for part, cut in (([], 1), (["zzz"], 1), (["zzz"], 0)))
            changed |= more
        texts = ["before it " + x + " after it" for x in sorted(changed)]
        row, _, _, h = folded_words(pa.array(texts))
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        found = {r for r, of, *_ in index.candidates(h, row, cut) if of == t}
        aligned = {r for r in range(len(texts)) if full_alignment(index.tokens[t].tolist(), h[cut[r]:cut[r + 1]].tolist())[0] <= allowed_edits(m)}
        assert aligned == set(range(len(texts))) and aligned <= found, name


def test_a_word_missing_or_added_in_the_shortest_notice(spark):
    docs = [(1, "Released under an MIT License."), (2, "Released under MIT License"), (3, "x Released now under the MIT License")]
    assert {(r.doc_id, r.license) for r in find_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == {
        (i, "MIT notice") for i in (1, 2, 3)}


def test_neighbouring_licenses_are_not_mistaken(spark):
    texts = {"Licensed under CC BY-SA 4.0.": {"CC BY-SA notice"}, "Licensed under the Mozilla License, Version 2.0": {"MPL notice"},
             "Released under the BSD License": {"BSD notice"}, "Released under the GPL License": set(), "Licensed under CC BY-NC-SA 4.0.": {"CC BY-NC-SA notice"},
             "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL notice"},
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": {"CC BY-NC long notice"},
             "Licensed under the Acme License, Version 2.0.": set(), "Licensed under CC BY-XX 4.0.": set(),
             TEMPLATES["Apache-2.0 header"]: {"Apache-2.0 header"},
             "SPDX-License-Identifier: BSD-2-Clause": {"BSD-3-Clause tag"}, "SPDX-License-Identifier: CC-BY-XX-4.0": set(),
             "spdx-license-identifier: gpl-2.0-or-later": {"GPL-3.0-or-later tag"}, "SPDX-License-Identifier: WTFPL": set(),
             "It is licensed under the terms of the MIT license": {"MIT terms notice"}, "Licensed under Apache License 2.0": {"Apache short notice"},
             "Dedicated with CC0 1.0 Universal": {"CC0 notice"}, TEMPLATES["MIT text"].replace("free of charge", "at no charge"): {"MIT text"},
             TEMPLATES["BSD three-clause text"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "): {"BSD three-clause text"},
             TEMPLATES["LGPL header"].replace("library", "program"): {"LGPL header"}}
    texts |= {text: {name} for name, text in TEMPLATES.items()}
    docs = spark.createDataFrame(list(enumerate(f"Some text. {t} And more." for t in texts)), "doc_id long, text string")
    got = [set() for _ in texts]
    for r in find_licenses(docs).collect():
        got[r.doc_id].add(r.license)
    assert dict(zip(texts, got)) == texts


def test_no_edit_in_the_naming_words():
    """One edit of a notice is accepted outside the words that name the license and nowhere in them."""
    fold = str.maketrans("123456789", "0" * 9)
    for name in (n for n in TEMPLATES if n in NAMING):
        index = TemplateIndex({name: TEMPLATES[name]})
        if len(index.tokens[0]) > 15:
            continue
        words = "".join(c if c.isalnum() else " " for c in TEMPLATES[name]).split()
        naming = NAMING[name].replace("-", " ").translate(fold).split()
        at = next(i for i in range(len(words)) if [w.translate(fold) for w in words[i:i + len(naming)]] == naming)
        texts, named = [], []
        for i in range(len(words)):
            for part, cut in (([], 1), (["zzz"], 1), (["zzz"], 0)):
                texts.append("before it " + " ".join(words[:i] + part + words[i + cut:]) + " after it")
                # with digits folded, "BY 4 0" without its 4 still reads "BY 0"
                still = " ".join(naming) in " ".join(words[:i] + part + words[i + cut:]).translate(fold)
                named.append(at + (cut == 0) <= i < at + len(naming) and not still)
        row, _, _, h = folded_words(pa.array(texts))
        found = {p[0] for p in index.find(h, row, np.searchsorted(row, np.arange(len(texts) + 1)))}
        assert found == {k for k in range(len(texts)) if not named[k]}, name


def test_edges(spark, edge_docs, wide_docs, no_docs):
    rows = [(r.doc_id, r.license) for r in find_licenses(edge_docs).collect()]
    assert rows == [(10, "MIT notice")] == [(r.doc_id, r.license) for r in find_licenses(wide_docs).collect()]
    assert find_licenses(no_docs).count() == 0
