"""Operator 5: license notices found by winnowed fingerprints and banded alignment.

The fingerprints of a token sequence are the smallest hashes of its windows of word
k-grams (winnowing): two sequences that share ``GRAM + WINNOW - 1`` tokens in a row share
a fingerprint. Templates' fingerprints form an inverted index; a document's own
fingerprints look up (template, diagonal) candidates. A template whose allowed edits can leave
shorter runs than that is indexed by all its grams of the longest run that must remain.
Each candidate is settled by an
edit-distance alignment of the template with the document's tokens inside a band
around the diagonal, as wide as the edits that the coverage allows; its matched share and
span are reported.

Digits are folded, so a notice is found for any version or year. The words that name a
license allow no edit, and where places overlap the best-fitting template is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tokens import U64, shingle_hashes, slices, span_hashes, text_bytes, word_spans

GRAM = 3
WINNOW = 2
MIN_COVERAGE = 0.8

# Wording of public license notices.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "GPL notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "CC BY-NC notice": "Licensed under CC BY-NC 4.0.",
    "CC BY notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    # neighbours, which differ from a notice above by the words that name the license
    "BSD notice": "Released under the BSD License.",
    "ISC notice": "Released under the ISC License.",
    "MPL notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "LGPL notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC BY short notice": "Licensed under CC BY 4.0.",
    "CC BY-SA notice": "Licensed under CC BY-SA 4.0.",
    "CC BY-ND notice": "Licensed under CC BY-ND 4.0.",
    "CC BY-NC-SA notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC BY-NC-ND notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC BY-SA long notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC BY-ND long notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC BY-NC long notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC BY-NC-SA long notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC BY-NC-ND long notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "MIT terms notice": "Licensed under the terms of the MIT license.",
    "Apache short notice": "Licensed under Apache License 2.0.",
    "CC0 notice": "CC0 1.0",
    "Boost notice": "Distributed under the Boost Software License, Version 1.0.",
    "EPL notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "LGPL header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
        "License for more details."),
    "AGPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    # whole texts; a part of one that is a template above is reported where the rest is missing
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "BSD two-clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "BSD three-clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
        "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."),
    "zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."),
}

# Identifiers of the tag line "SPDX-License-Identifier"; digits are folded, so one stands for its versions.
TAGGED = [
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "EUPL-1.2", "GPL-3.0",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
]
TEMPLATES |= {f"{x} tag": f"SPDX-License-Identifier: {x}" for x in TAGGED}

# Words in a row that must stand unchanged in a place of the template; long texts without a name have none.
NAMING = {
    "Apache-2.0 notice": "Apache", "Apache-2.0 header": "Apache License", "MIT notice": "MIT", "GPL notice": "GNU General Public",
    "GPL header": "GNU General Public License", "CC BY-NC notice": "CC BY-NC", "CC BY notice": "Creative Commons Attribution",
    "Unlicense": "unencumbered", "MPL-2.0": "Mozilla Public License", "BSD notice": "BSD", "ISC notice": "ISC", "MPL notice": "Mozilla",
    "LGPL notice": "GNU Lesser General Public", "AGPL notice": "GNU Affero General Public", "CC BY short notice": "CC BY 4",
    "CC BY-SA notice": "CC BY-SA", "CC BY-ND notice": "CC BY-ND", "CC BY-NC-SA notice": "CC BY-NC-SA", "CC BY-NC-ND notice": "CC BY-NC-ND",
    "CC BY-SA long notice": "Creative Commons Attribution-ShareAlike", "CC BY-ND long notice": "Creative Commons Attribution-NoDerivatives",
    "CC BY-NC long notice": "Creative Commons Attribution-NonCommercial",
    "CC BY-NC-SA long notice": "Creative Commons Attribution-NonCommercial-ShareAlike",
    "CC BY-NC-ND long notice": "Creative Commons Attribution-NonCommercial-NoDerivatives",
    "MIT terms notice": "MIT", "Apache short notice": "Apache License", "CC0 notice": "CC0 1 0", "Boost notice": "Boost Software License",
    "EPL notice": "Eclipse Public License", "LGPL header": "GNU Lesser General Public License", "AGPL header": "GNU Affero General Public License",
}
NAMING |= {f"{x} tag": f"SPDX License Identifier {x}".replace("-", " ").replace(".", " ") for x in TAGGED}

NOT_TOKEN = np.ones(256, bool)
NOT_TOKEN[48:58] = NOT_TOKEN[65:91] = NOT_TOKEN[97:123] = NOT_TOKEN[128:] = False
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[48:58] = 48


def folded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, byte start, byte end (in the batch) and hash of the words; digits count as 0."""
    data, offsets = text_bytes(column)
    start, end = word_spans(data, offsets, NOT_TOKEN)
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start, end, span_hashes(_FOLDED[data], start, end)


def winnow(tokens: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (hash, token position): the smallest hash, the rightmost of equals, of each run of grams.

    A text with fewer than WINNOW grams gives its only window's smallest.
    """
    n = len(tokens) - GRAM + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    whole = np.flatnonzero(row[:n] == row[GRAM - 1:])
    h, gram_row = shingle_hashes(tokens, row, GRAM)
    together = gram_row[1:] == gram_row[:-1]  # WINNOW = 2: neighbours
    pick = np.ones(len(h), bool)  # a lone gram stands for its text
    pick[1:] &= ~together
    pick[:-1] &= ~together
    left = np.flatnonzero(together)
    pick[np.where(h[left] < h[left + 1], left, left + 1)] = True
    at = np.flatnonzero(pick)
    return h[at], whole[at]


def allowed_edits(length: int) -> int:
    return int(length * (1 - MIN_COVERAGE) + 1e-9)


def align(template: np.ndarray, text: np.ndarray, centre: int, band: int) -> tuple[int, int, int, int]:
    """Best alignment of the whole template inside ``text``, within ``band`` of the diagonal ``centre``.

    ``centre`` is where the template's first token would stand. Cost 1 for each
    substituted, missing or extra token; text before and after costs nothing. Returns
    (cost, equal tokens, start, end) with the least cost, then the most equal tokens,
    then the earliest end.
    """
    m = len(template)
    lo, hi = max(0, centre - band), min(len(text), centre + m + band)
    part = text[lo:hi]
    width = len(part)
    # key: cost * BIG - equal tokens; start travels along
    big = m + 1
    cost = np.zeros(width + 1, np.int64)
    start = np.arange(width + 1)
    columns = np.arange(width + 1)
    for i in range(m):
        diagonal = cost[:-1] + np.where(part == template[i], -1, big)
        up = cost + big
        new, where = up.copy(), start.copy()
        better = diagonal < new[1:]
        new[1:][better] = diagonal[better]
        where[1:][better] = start[:-1][better]
        # extra text tokens: a running minimum along the row
        flat = new - columns * big
        least = np.minimum.accumulate(flat)
        fresh = np.r_[True, flat[1:] < least[:-1]]
        source = np.maximum.accumulate(np.where(fresh, columns, 0))
        cost, start = least + columns * big, where[source]
        outside = np.abs(columns + lo - centre - (i + 1)) > band
        cost = np.where(outside, 1 << 40, cost)
    end = int(np.argmin(cost))
    key = int(cost[end])
    errors = -(-key // big)
    return errors, errors * big - key, lo + int(start[end]), lo + end


#: row, template, coverage, errors, first token, end token
Place = tuple[int, int, float, int, int, int]


def holds(text: np.ndarray, phrase: np.ndarray) -> bool:
    """Whether the words of ``phrase`` stand in a row in ``text``."""
    n = len(text) - len(phrase) + 1
    if n <= 0:
        return False
    here = np.ones(n, bool)
    for k, word in enumerate(phrase):
        here &= text[k:k + n] == word
    return bool(here.any())


def best_fitting(places: list[Place], lengths: list[int]) -> list[Place]:
    """Without places of which half or more lies in, or covers half of, one that fits better.

    The fit is equal tokens less errors. Templates that fit equally well are all reported,
    a template's own overlapping places once.
    """
    fit = lambda p: round(p[2] * lengths[p[1]]) - p[3]
    kept: dict[int, list[Place]] = {}
    for p in sorted(places, key=lambda p: (p[0], -fit(p), p[3], p[4], p[1])):
        own = kept.setdefault(p[0], [])
        for q in own:
            shared = min(p[5], q[5]) - max(p[4], q[4])
            if 2 * shared >= min(p[5] - p[4], q[5] - q[4]) and (fit(q) > fit(p) or q[1] == p[1]):
                break
        else:
            own.append(p)
    return [p for own in kept.values() for p in sorted(own, key=lambda p: (p[4], p[1]))]


def sure_run(length: int) -> int:
    """Equal tokens in a row that a template of this length keeps under any allowed edits."""
    edits = allowed_edits(length)
    return -(-(length - edits) // (edits + 1))


class TemplateIndex:
    """Templates as token hashes with the inverted indexes of their fingerprints, by gram size (0: winnowed)."""

    def __init__(self, templates: dict[str, str], naming: dict[str, str] = NAMING):
        self.names = list(templates)
        self.naming = [folded_words(pa.array([naming.get(n, "")], pa.string()))[3] for n in self.names]
        column = pa.array([templates[n] for n in self.names], pa.string())
        row, _, _, h = folded_words(column)
        cut = np.searchsorted(row, np.arange(len(self.names) + 1))
        self.tokens = [h[a:b] for a, b in zip(cut[:-1], cut[1:])]
        run = np.array([sure_run(len(x)) for x in self.tokens], np.int64)
        size = np.where(run >= GRAM + WINNOW - 1, 0, np.minimum(run, GRAM))
        self.grams = {}
        for k in sorted(set(size.tolist())):
            finger, at = self._fingers(h, row, k)
            own = size[row[at]] == k
            finger, at = finger[own], at[own]
            order = np.argsort(finger, kind="stable")
            self.grams[k] = finger[order], row[at[order]], at[order] - cut[row[at[order]]]

    @staticmethod
    def _fingers(tokens: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Winnowed fingerprints, or all grams of a size, and the positions of their first tokens."""
        if not size:
            return winnow(tokens, row)
        return shingle_hashes(tokens, row, size)[0], np.flatnonzero(row[:max(len(row) - size + 1, 0)] == row[size - 1:])

    def candidates(self, tokens: np.ndarray, row: np.ndarray, cut: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, template, token position of the template's start), one per band of diagonals."""
        named = set()
        for size, (known, template, position) in self.grams.items():
            if not len(known):  # templates without a word
                continue
            finger, at = self._fingers(tokens, row, size)
            lo = np.searchsorted(known, finger, side="left")
            some = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == finger)
            lo, at = lo[some], at[some]
            n = np.searchsorted(known, finger[some], side="right") - lo
            hit = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            where = np.repeat(at, n)
            start, of = where - position[hit], template[hit]
            likely = self._likely(tokens, cut, row[where], of, start)
            named.update(zip(row[where][likely].tolist(), of[likely].tolist(), start[likely].tolist()))
        out: list[tuple[int, int, int]] = []
        for r, t, start in sorted(named):
            if not out or out[-1][:2] != (r, t) or start - out[-1][2] > allowed_edits(len(self.tokens[t])):
                out.append((r, t, start))
        return out

    def _likely(self, tokens: np.ndarray, cut: np.ndarray, row: np.ndarray, of: np.ndarray, start: np.ndarray) -> np.ndarray:
        """False where too few tokens of a short template stand within its edits of their places."""
        out = np.ones(len(of), bool)
        for t in np.unique(of).tolist():
            template, edits = self.tokens[t], allowed_edits(len(self.tokens[t]))
            if edits > 2:
                continue
            own = np.flatnonzero(of == t)
            equal = np.zeros(len(own), np.int64)
            for i, token in enumerate(template):
                near = np.zeros(len(own), bool)
                for shift in range(-edits, edits + 1):
                    at = start[own] + i + shift
                    inside = (at >= cut[row[own]]) & (at < cut[row[own] + 1])
                    near |= inside & (tokens[np.where(inside, at, 0)] == token)
                equal += near
            out[own] = equal >= len(template) - edits
        return out

    def find(self, tokens: np.ndarray, row: np.ndarray, cut: np.ndarray) -> list[Place]:
        """The accepted places."""
        seen, places = set(), []
        for r, t, start in self.candidates(tokens, row, cut):
            template, a, b = self.tokens[t], int(cut[r]), int(cut[r + 1])
            m = len(template)
            if start >= a and start + m <= b and np.array_equal(tokens[start:start + m], template):
                errors, equal, first, end = 0, m, start - a, start - a + m
            else:
                errors, equal, first, end = align(template, tokens[a:b], start - a, 2 * allowed_edits(m) + 1)
            coverage = equal / m
            if (coverage >= MIN_COVERAGE and errors <= allowed_edits(m) and (r, t, first) not in seen
                    and holds(tokens[a + first:a + end], self.naming[t])):
                seen.add((r, t, first))
                places.append((r, t, coverage, errors, first, end))
        return best_fitting(places, [len(x) for x in self.tokens])


FOUND = "doc_id long, license string, coverage double, n_errors int, first_word int, end_word int, start_byte long, end_byte long"


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, naming: dict[str, str] = NAMING) -> DataFrame:
    """One row for each place where a document holds a license template.

    A place is reported where at least ``MIN_COVERAGE`` of the template's tokens match in
    order, with no more than the remaining share of edits and none in the words that name the
    license (``naming``). Of places that overlap by half of the shorter one, that with the most
    equal tokens less edits is reported, so a notice inside a longer header is not; equal
    fits are reported each. Spans are in words
    and in UTF-8 bytes of the text. The template set is a parameter of bounded size;
    documents are read in one map pass over whole texts.

    Defined cases: null or empty texts hold no license; repeated rows are reported each;
    a notice that occurs several times is reported at each place; an empty table gives
    an empty result; other columns are ignored.
    """
    index = TemplateIndex(templates, naming)
    names = ["doc_id", "license", "coverage", "n_errors", "first_word", "end_word", "start_byte", "end_byte"]
    types = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, start, end, h = folded_words(batch.column("text"))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            offsets = text_bytes(batch.column("text"))[1]
            ids = batch.column("doc_id").to_pylist()
            out = [(ids[r], index.names[t], coverage, errors, first, last,
                    int(start[cut[r] + first] - offsets[r]), int(end[cut[r] + last - 1] - offsets[r]))
                   for r, t, coverage, errors, first, last in index.find(h, row, cut)]
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, FOUND)


def op5_license_scan(spark, sf_dir):
    return find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
