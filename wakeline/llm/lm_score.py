"""Operator 7: a hierarchical Pitman-Yor language model over the corpus, by Gibbs sampling.

Every word is a dish ordered in the restaurant of its context; the context restaurants share
one parent, the word restaurant, whose own parent is uniform over the vocabulary. A new
table in a context restaurant is a customer of the parent, so rare events borrow from it:

    p(w|u) = (c_uw - d t_uw) / (s + c_u) + (s + d t_u) / (s + c_u) * p(w)

A context is the class of the word before (``CONTEXTS`` hash classes, the start of a text
among them), so totals per context are a bounded array. Seatings are sampled by
Gibbs sweeps: a sweep seats the customers of every (context, word) cell anew, given the
parent and the other tables of the restaurant as of the sweep before. Given these a cell needs
only its number of tables, drawn from its conditional distribution (generalized Stirling
numbers), so all cells of a bucket are seated together.
Probabilities are averaged over the sweeps after the burn-in.

On the cluster: occurrences are folded to (cell, document, count) in the scan and dealt
to buckets by word; the few words that are large next to a bucket are dealt by cell, the
occurrences of a cell that is so large by task, and their counts travel with the totals. A bucket holds all it needs for training
and scoring its cells. A sweep returns totals per context only; its seating is not
stored but replayed from its seed and those totals, so a lost task repeats it exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import shuffle_width, stored
from wakeline.llm.tokens import U64, give_back, mix, release, slices, words_of

CONTEXTS = 1 << 14
START = 0
END_WORD = U64(0xE0D)
FLUSH_TOKENS = 1_000_000
DEAL_TOKENS = 500_000
FLUSH_DOCS = 60_000
BUCKET_TEXT = 4 << 20        # bytes of text per bucket
SCORE_TEXT = 100 << 20        # bytes of text per scoring task
EXACT = 256                  # customers up to which seatings are weighed by recursion
DENSE = 16                   # customers up to which all numbers of tables are weighed
SEAT_VALUES = 1 << 18         # weights held at a time
MERGE_DOCS = 500_000          # document sums that a scoring task holds, about


@dataclass(frozen=True)
class LmParams:
    sweeps: int = 3
    burn_in: int = 1
    strength: float = 1.0
    seed: int = 17


def context_class(previous: np.ndarray) -> np.ndarray:
    return (mix(previous, 51) % U64(CONTEXTS - 1)).astype(np.int64) + 1


def document_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word hash and context class of all tokens; every text ends with the end token."""
    words = words_of(column)
    n = len(column)
    per_text = np.bincount(words.row, minlength=n)
    ends = np.cumsum(per_text + 1) - 1
    token = np.empty(len(words.row) + n, U64)
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word], token[ends] = words.hash, END_WORD
    context = np.empty(len(token), np.int64)
    context[1:] = context_class(token[:-1])
    context[ends[:-1] + 1] = START
    context[:1] = START
    return np.repeat(np.arange(n), per_text + 1), token, context


class Hot(NamedTuple):
    """Words, and cells of them, that are large next to a bucket. Both sorted; cells as (index of the word, context)."""

    words: np.ndarray
    cell_word: np.ndarray
    cell_context: np.ndarray

    def word_index(self, word: np.ndarray) -> np.ndarray:
        """Index of each word, -1 for words that are not hot."""
        if not len(self.words):
            return np.full(len(word), -1)
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        return np.where(self.words[at] == word, at, -1)

    def cell_index(self, word_index: np.ndarray, context: np.ndarray) -> np.ndarray:
        if not len(self.cell_word):
            return np.full(len(word_index), -1)
        cells = self.cell_word * CONTEXTS + self.cell_context
        key = word_index * CONTEXTS + context
        at = np.minimum(np.searchsorted(cells, key), len(cells) - 1)
        return np.where((word_index >= 0) & (cells[at] == key), at, -1)


def find_hot(rows: DataFrame, n_buckets: int) -> Hot:
    """Words and cells with more than an eighth of a bucket's tokens (fewer than 16 of each per bucket).

    They only decide where occurrences are dealt; a task leaves out what is far below the bound.
    """
    @give_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summary() -> pa.RecordBatch:
            token, context = (np.concatenate(x) for x in zip(*kept))
            word, inverse, n = np.unique(token, return_inverse=True, return_counts=True)
            big = n * (16 * n_buckets) >= len(token)
            of_big = np.flatnonzero(big[inverse])
            cell, m = np.unique(inverse[of_big] * CONTEXTS + context[of_big], return_counts=True)
            large = m * (16 * n_buckets) >= len(token)
            cell, m = cell[large], m[large]
            words = np.concatenate([word[big], word[cell // CONTEXTS], np.zeros(1, U64)]).astype(np.int64)
            contexts = np.concatenate([np.full(int(big.sum()), -1), cell % CONTEXTS, [-2]])  # -1: a word, -2: all tokens
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(contexts), pa.array(np.concatenate([n[big], m, [len(token)]]))],
                                              ["word", "context", "n"])

        for batch in slices(batches, "text"):
            kept.append(document_tokens(batch.column("text"))[1:])
            size += len(kept[-1][0])
            if size >= FLUSH_TOKENS:
                yield summary()
                kept, size = [], 0
        if kept:
            yield summary()

    counted = rows.select("text").mapInArrow(count, "word long, context long, n long")
    sums = counted.groupBy("word", "context").agg(F.sum("n").alias("n"))
    total = sums.where("context = -2").agg(F.sum("n")).first()[0] or 0
    found = sums.where((F.col("context") >= -1) & (F.col("n") * 8 * n_buckets >= total)).select("word", "context").collect()
    words = np.sort(np.array([r["word"] for r in found if r["context"] == -1], np.int64).astype(U64))
    index = {int(w): i for i, w in enumerate(words.astype(np.int64).tolist())}
    cells = np.array(sorted((index[r["word"]], r["context"]) for r in found if r["context"] >= 0), np.int64).reshape(-1, 2)
    return Hot(words, cells[:, 0], cells[:, 1])


def _bucket_of(word: np.ndarray, context: np.ndarray, salt: int, hot: Hot, n_buckets: int) -> np.ndarray:
    """By word; cells of a hot word each on their own; a hot cell's occurrences wherever ``salt`` puts them."""
    index = hot.word_index(word)
    cell = hot.cell_index(index, context)
    with np.errstate(over="ignore"):
        key = np.where(index >= 0, mix(word + context.astype(U64), 52), word)
        key = np.where(cell >= 0, mix(key + U64(salt), 54), key)
    return (mix(key, 53) % U64(n_buckets)).astype(np.int64)


BLOBS = {"words": "<u8", "word_cells": "<u4", "cell_context": "<u2", "cell_records": "<u4", "record_doc": "<u2", "record_n": "<u4"}
DEALT = "bucket int, kind int, first_row long, doc_ids binary, held binary, " + ", ".join(f"{c} binary" for c in BLOBS)


def _deal(hot: Hot, n_buckets: int):
    """Occurrences folded per (cell, document) and packed per bucket; documents packed per flush."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("first_row", pa.int64()),
                        ("doc_ids", pa.binary()), ("held", pa.binary()), *((c, pa.binary()) for c in BLOBS)])

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        row, word, context, doc, doc_id, held = (np.concatenate(x) for x in zip(*parts))
        first = int(doc[0])  # rows of a task are numbered one after the other
        row_n = (doc - first).astype(np.int64)[row]
        yield pa.RecordBatch.from_pylist([{"bucket": first % n_buckets, "kind": 0, "first_row": first,
                                           "doc_ids": doc_id.astype("<i8").tobytes(), "held": held.astype("<u1").tobytes()}], schema=schema)
        bucket = _bucket_of(word, context, first, hot, n_buckets)
        order = np.lexsort((row_n, context, word, bucket))
        b, w, u, d = bucket[order], word[order], context[order], row_n[order]
        new_bucket = np.append(True, b[1:] != b[:-1])
        new_word = new_bucket | np.append(True, w[1:] != w[:-1])
        new_cell = new_word | np.append(True, u[1:] != u[:-1])
        new_record = new_cell | np.append(True, d[1:] != d[:-1])
        record = np.flatnonzero(new_record)
        # twice the count, plus one for a document that is learned from
        record_n = np.diff(np.append(record, len(d))) * 2 + (held != 1)[d[record]]
        cell, words = np.flatnonzero(new_cell), np.flatnonzero(new_word)
        record_at, cell_at, word_at = np.cumsum(new_record), np.cumsum(new_cell), np.cumsum(new_word)
        cell_records = np.diff(np.append(record_at[cell], len(record) + 1))
        word_cells = np.diff(np.append(cell_at[words], len(cell) + 1))
        at = np.flatnonzero(new_bucket)
        stop = np.append(at[1:], len(d))
        for lo, hi in zip(at.tolist(), stop.tolist()):
            r, c, k = (slice(int(x[lo]) - 1, int(x[hi - 1])) for x in (record_at, cell_at, word_at))
            packed = {"words": w[words[k]], "word_cells": word_cells[k], "cell_context": u[cell[c]], "cell_records": cell_records[c],
                      "record_doc": d[record[r]], "record_n": record_n[r]}
            yield pa.RecordBatch.from_pylist([{"bucket": int(b[lo]), "kind": 1, "first_row": first,
                                               **{n: x.astype(BLOBS[n]).tobytes() for n, x in packed.items()}}], schema=schema)

    @give_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n_tokens, n_docs = [], 0, 0
        for batch in slices(batches, "text"):
            for lo in range(0, batch.num_rows, FLUSH_DOCS):
                own = batch.slice(lo, FLUSH_DOCS)
                row, word, context = document_tokens(own.column("text"))
                if parts and (n_tokens + len(word) > DEAL_TOKENS or n_docs + own.num_rows > FLUSH_DOCS):
                    yield from flush(parts)
                    parts, n_tokens, n_docs = [], 0, 0
                ids = own.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                parts.append((row + n_docs, word, context, own.column("row").to_numpy(), ids,
                              own.column("held_out").to_numpy(zero_copy_only=False)))
                n_tokens += len(word)
                n_docs += own.num_rows
        if parts:
            yield from flush(parts)
    return deal


STATE = {"word_count": "<u4", "word_hot": "<i4", "word_cells": "<u4", "cell_context": "<u2", "cell_hot": "<i4", "cell_count": "<u4",
         "cell_records": "<u4", "record_doc": "<u4", "record_n": "<u4", "doc_step": "<u8"}
GATHERED = "bucket int, kind int, first_row long, doc_ids binary, held binary, " + ", ".join(f"{c} binary" for c in STATE)


def squeeze(x: np.ndarray, kind: str) -> bytes:
    """An array as compressed bytes behind its size: most counts are 1, most steps are small."""
    raw = x.astype(kind).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: pa.Buffer, kind: str) -> np.ndarray:
    n = int.from_bytes(data[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(data[8:], n, codec="zstd"), kind)


def _runs(size: np.ndarray) -> np.ndarray:
    """Index of the run that each element belongs to."""
    return np.repeat(np.arange(len(size)), size)


def _gather(hot: Hot):
    """One bucket's blobs as sorted cells with training counts and the records of each cell."""
    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        release()  # what the group before has left
        bucket = int(rows["bucket"].iloc[0])
        docs = rows.loc[rows["kind"] == 0, ["bucket", "kind", "first_row", "doc_ids", "held"]]
        blobs = rows[rows["kind"] == 1]
        out = [docs]
        if len(blobs):
            got = {c: [np.frombuffer(x, t) for x in blobs[c]] for c, t in BLOBS.items()}
            doc = np.concatenate([d.astype(np.int64) + f for d, f in zip(got["record_doc"], blobs["first_row"])])
            words, word_of = np.unique(np.concatenate(got["words"]), return_inverse=True)
            n = {c: np.concatenate(got[c]).astype(np.int64) for c in BLOBS if c not in ("words", "record_doc")}
            key = (word_of[_runs(n["word_cells"])] << 14) | n["cell_context"]
            key = key[_runs(n["cell_records"])]
            uid, doc_index = np.unique(doc, return_inverse=True)
            order = np.lexsort((doc_index, key))
            key, doc_index, times = key[order], doc_index[order], n["record_n"][order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            learned = np.where(times & 1, times >> 1, 0)
            cell_count = np.add.reduceat(learned, first)
            cell_word = key[first] >> 14
            word_hot = hot.word_index(words)
            state = {"word_count": np.bincount(cell_word, weights=cell_count, minlength=len(words)), "word_hot": word_hot,
                     "word_cells": np.bincount(cell_word, minlength=len(words)), "cell_context": key[first] & (CONTEXTS - 1),
                     "cell_hot": hot.cell_index(word_hot[cell_word], key[first] & (CONTEXTS - 1)),
                     "cell_count": cell_count, "cell_records": np.diff(np.append(first, len(key))), "record_doc": doc_index,
                     "record_n": times >> 1, "doc_step": np.diff(uid, prepend=0)}
            out.append(pd.DataFrame({"bucket": [bucket], "kind": [1], "first_row": [0],
                                     **{c: [squeeze(x, STATE[c])] for c, x in state.items()}}))
        both = pd.concat(out, ignore_index=True)
        return both.reindex(columns=["bucket", "kind", "first_row", "doc_ids", "held", *STATE]).astype(object).where(lambda f: f.notna(), None)
    return gather


@dataclass
class Totals:
    """What the buckets need to know of each other. Arrays per context, per hot word, and per sweep."""

    tokens: int = 0                 # training tokens
    vocabulary: int = 0             # distinct training tokens
    discount: float = 0.5           # of the context restaurants
    root_discount: float = 0.5
    context_count: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXTS))
    hot_count: np.ndarray = field(default_factory=lambda: np.zeros(0))
    tables: list[np.ndarray] = field(default_factory=list)       # per sweep: tables by context
    hot_customers: list[np.ndarray] = field(default_factory=list)  # per sweep: parent customers by hot word
    hot_cell_count: np.ndarray = field(default_factory=lambda: np.zeros(0))
    hot_cell_tables: list[np.ndarray] = field(default_factory=list)  # per sweep
    root_tables: list[float] = field(default_factory=list)       # per sweep


class Seatings:
    """Ratios ``S(n, t + 1) / S(n, t)`` of the generalized Stirling numbers of a discount, as logarithms.

    ``S(n, t)`` is the weight of all seatings of ``n`` customers at ``t`` tables. Up to ``EXACT``
    customers they come from their recursion. Past it they are coefficients taken at the
    saddle point of ``((1 - (1 - u)^d) / d)^t``, with the factor by which that misses the recursion
    for as few tables (its part in ``n^-d`` from two numbers of customers), or for as few customers
    over the tables.
    """

    NEAR = 64

    def __init__(self, discount: float):
        d = discount
        self.exact = np.zeros((EXACT + 1, EXACT))  # [n, t - 1]
        log_s = np.zeros(1)
        for n in range(1, EXACT):
            own = log_s + np.log(n - d * np.arange(1, n + 1))
            log_s = np.append(np.append(own[:1], np.logaddexp(own[1:], log_s[:-1])), log_s[-1])
            self.exact[n + 1, :n] = np.diff(log_s)
        u = np.exp(np.linspace(np.log(1e-6), np.log(0.5), 2000))
        z = np.exp(np.linspace(np.log(0.5), -650, 6000)[1:])
        u, z = np.append(u, 1 - z), np.append(1 - u, z)
        log_z = np.append(np.log1p(-u[:2000]), np.log(z[2000:]))
        f = -np.expm1(d * log_z) / d
        g = u * np.exp((d - 1) * log_z) / f  # customers per table at the saddle point u
        self.grid, self.log_f = np.log(g - 1), np.log(f)
        self.log_spread = np.log(g) + np.log(1 + (1 - d) * u / z - g)
        t = np.arange(1, self.NEAR + 1)
        missed = [self.exact[n, t - 1] - self._saddle(n, t) for n in (EXACT // 2, EXACT)]
        self.discount, self.few = d, missed[1]
        self.few_step = (missed[0] - missed[1]) / (2 ** d - 1)
        self.many = self.exact[EXACT, EXACT - t - 1] - self._saddle(EXACT, EXACT - t)  # t customers over the tables

    def _spread(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        y = np.log(np.maximum(n / t - 1, 1e-300))
        return np.maximum(np.log(t) + np.interp(y, self.grid, self.log_spread), np.log(0.1)) / 2

    def _saddle(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        f = np.interp(np.log(n / (t + 0.5) - 1), self.grid, self.log_f)
        return f - np.log(t + 1) - self._spread(n, t + 1) + self._spread(n, t)

    def past_exact(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        """For more than ``EXACT`` customers, and 1 <= t < n."""
        out = self._saddle(n, t)
        at = np.minimum(t, self.NEAR) - 1
        out += np.where(t <= self.NEAR, self.few[at] + self.few_step[at] * ((n / EXACT) ** -self.discount - 1), 0)
        return out + np.where(n - t <= self.NEAR, self.many[np.minimum(n - t, self.NEAR) - 1], 0)


seatings = lru_cache(4)(Seatings)


def _last(lo: np.ndarray, hi: np.ndarray, holds) -> np.ndarray:
    """The largest ``t`` in ``lo..hi`` for which ``holds(t)``, which it does up to there; ``lo`` if it never does."""
    lo, hi = lo.copy(), hi.copy()
    while (lo < hi).any():
        middle = (lo + hi + 1) // 2
        yes = holds(middle)
        lo, hi = np.where(yes, middle, lo), np.where(yes, hi, np.maximum(middle - 1, lo))
    return lo


def seat(customers: np.ndarray, strength: np.ndarray | float, discount: float, parent: np.ndarray | float,
         rng: np.random.Generator) -> np.ndarray:
    """Tables that ``customers`` of each dish take, drawn from their distribution given all other dishes.

    ``strength`` is the concentration plus the discount of all other dishes' tables. ``t``
    tables have weight ``S(n, t) parent^t`` times the product of ``strength + discount j`` for
    j < t. The draw is a Gibbs step of the whole cell: it depends on the cell's customers
    and the others' tables, not on how the cell was seated before.
    """
    out = np.minimum(customers, 1).astype(np.float64)
    several = np.flatnonzero(customers > 1)  # one customer takes one table
    several = several[np.argsort(customers[several], kind="stable")]
    n = customers[several].astype(np.int64)
    s = np.broadcast_to(strength, customers.shape)[several].astype(np.float64)
    p = np.broadcast_to(parent, customers.shape)[several].astype(np.float64)
    u = rng.random(len(n))
    ratios = seatings(float(discount))
    t = np.ones(len(n), np.int64)
    exact = int(np.searchsorted(n, EXACT, side="right"))
    dense = int(np.searchsorted(n, DENSE, side="right"))
    cut = np.searchsorted(n[:dense], np.arange(2, DENSE + 2))
    for size, lo, hi in zip(range(2, DENSE + 1), cut[:-1].tolist(), cut[1:].tolist()):
        for a in range(lo, hi, SEAT_VALUES // size):
            k = slice(a, min(a + SEAT_VALUES // size, hi))
            w = np.empty((size, k.stop - a))  # by tables
            np.log(p[k] * (s[k] + discount * np.arange(1, size)[:, None]), out=w[1:])
            w[1:] += ratios.exact[size, :size - 1, None]
            w[0] = 0
            np.cumsum(w, axis=0, out=w)
            w -= w.max(axis=0)
            np.cumsum(np.exp(w, out=w), axis=0, out=w)
            t[k] = 1 + (w[:-1] <= u[k] * w[-1]).sum(axis=0)
    for k, ratio in ((slice(dense, exact), lambda n, t: ratios.exact[n, t - 1]), (slice(exact, len(n)), ratios.past_exact)):
        if k.start < k.stop:
            t[k] = _seat_in_window(n[k], s[k], discount, p[k], u[k], ratio)
    out[several] = t
    return out


def _seat_in_window(n: np.ndarray, s: np.ndarray, discount: float, p: np.ndarray, u: np.ndarray, ratio) -> np.ndarray:
    """The same for larger cells: the weights left out at either side are far below e^-20 of the largest."""
    gain = lambda t: np.log((s + discount * t) * p) + ratio(n, t)
    one = np.ones(len(n), np.int64)
    top = _last(one, n - 1, lambda t: gain(t) > 0)
    first = _last(one, top, lambda t: (top - t) * gain(t) > 80)
    last = _last(top, n - 1, lambda t: (t - top) * gain(t) > -80)
    size = last - first + 2
    out = np.empty(len(n), np.int64)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(size[lo:]), SEAT_VALUES, side="right")))
        width = size[lo:hi]
        start = np.cumsum(width) - width
        cell = np.repeat(np.arange(lo, hi), width)
        step = np.arange(len(cell)) - np.repeat(start, width)  # tables over the first
        tables = np.maximum(first[cell] + step - 1, 1)
        log_w = np.log((s[cell] + discount * tables) * p[cell]) + ratio(n[cell], np.minimum(tables, n[cell] - 1))
        log_w[start] = 0
        log_w = np.cumsum(log_w)
        log_w -= np.repeat(log_w[start], width)
        w = np.exp(log_w - np.repeat(np.maximum.reduceat(log_w, start), width))
        total = np.add.reduceat(w, start)
        w = np.cumsum(w)
        before = np.append(0, w[start[1:] - 1])
        below = w <= np.repeat(before + u[lo:hi] * total, width)
        out[lo:hi] = first[lo:hi] + np.minimum(np.add.reduceat(below, start, dtype=np.int64), width - 1)
        lo = hi
    return out


class Bucket:
    """The cells of one bucket and their seatings, replayed sweep by sweep."""

    def __init__(self, number: int, columns: dict[str, pa.Buffer], totals: Totals, params: LmParams):
        self.number, self.totals, self.params = number, totals, params
        x = {c: unsqueeze(columns[c], STATE[c]).astype(np.int64) for c in ("word_count", "word_hot", "word_cells", "cell_context", "cell_hot", "cell_count")}
        self.word_count, self.word_hot, self.context, self.count = x["word_count"], x["word_hot"], x["cell_context"], x["cell_count"]
        self.word = _runs(x["word_cells"])
        self.hot = self.word_hot >= 0
        # a cell of one customer has one table whatever happens: only the others are seated anew
        self.cell_hot, self.in_hot = x["cell_hot"], x["cell_hot"] >= 0  # a hot cell's occurrences are in many buckets
        self.several = np.flatnonzero((self.count > 1) & ~self.in_hot)
        self.tables = np.ones(len(self.several))
        single = (self.count == 1) & ~self.in_hot
        self.single_by_word = np.bincount(self.word[single], minlength=len(self.word_count))
        self.single_by_context = np.bincount(self.context[single], minlength=CONTEXTS)
        self.sweep = 0
        self.rooted: tuple = (-1,)  # sweep, customers and tables of the parent, as last seated

    def _rng(self, *key: int) -> np.random.Generator:
        return np.random.default_rng([self.params.seed, *key])

    def customers(self) -> np.ndarray:
        """Customers of the parent by word; for hot words this bucket's part, without the hot cells."""
        return self.single_by_word + np.bincount(self.word[self.several], weights=self.tables, minlength=len(self.word_count))

    def tables_by_context(self) -> np.ndarray:
        return self.single_by_context + np.bincount(self.context[self.several], weights=self.tables, minlength=CONTEXTS)

    def root(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of the parent by word, for the current sweep's seating."""
        t, s = self.totals, self.sweep
        if self.rooted[0] == s:
            return self.rooted[1:]
        c = self.customers()
        others = t.root_tables[s - 1] - self.rooted[2] if s else t.vocabulary - 1.0
        strength = self.params.strength + t.root_discount * others
        tables = seat(np.where(self.hot, 0, c).astype(np.int64), strength, t.root_discount, 1 / (t.vocabulary + 1), self._rng(s, 1, self.number))
        if self.hot.any():
            tables[self.hot] = hot_root_tables(t, s, self.params)[self.word_hot[self.hot]]
            c[self.hot] = t.hot_customers[s][self.word_hot[self.hot]]
        self.rooted = s, c, tables
        return c, tables

    def parent(self, root_tables: float) -> np.ndarray:
        """p(w) by word."""
        t, strength = self.totals, self.params.strength
        c, tables = self.root()
        total = t.tables[self.sweep].sum()
        return (c - t.root_discount * tables + (strength + t.root_discount * root_tables) / (t.vocabulary + 1)) / (strength + total)

    def reseat(self) -> None:
        """One Gibbs sweep over the cells of this bucket."""
        t, s = self.totals, self.sweep
        parent = self.parent(t.root_tables[s - 1] if s else float(t.vocabulary))
        others = t.tables[s][self.context[self.several]] - self.tables
        self.tables = seat(self.count[self.several], self.params.strength + t.discount * others, t.discount,
                           parent[self.word[self.several]], self._rng(s, 2, self.number))
        self.sweep += 1

    def probabilities(self) -> np.ndarray:
        """p(w|u) by cell, at the current seating."""
        t, s = self.totals, self.sweep
        strength = self.params.strength
        parent = self.parent(t.root_tables[s])
        seen = strength + t.context_count[self.context]
        new = strength + t.discount * t.tables[s][self.context]
        count = self.count.astype(np.float64)
        tables = np.minimum(count, 1)
        tables[self.several] = self.tables
        count[self.in_hot] = t.hot_cell_count[self.cell_hot[self.in_hot]]
        tables[self.in_hot] = t.hot_cell_tables[s][self.cell_hot[self.in_hot]]
        return (count - t.discount * tables + new * parent[self.word]) / seen


def hot_root_tables(t: Totals, sweep: int, params: LmParams) -> np.ndarray:
    """Parent tables of the hot words: the same in every bucket."""
    others = t.root_tables[sweep - 1] - hot_root_tables(t, sweep - 1, params) if sweep else t.vocabulary - 1.0
    return seat(t.hot_customers[sweep].astype(np.int64), params.strength + t.root_discount * others, t.root_discount,
                1 / (t.vocabulary + 1), np.random.default_rng([params.seed, sweep, 3]))


def reseat_hot_cells(t: Totals, sweep: int, hot: Hot, params: LmParams) -> np.ndarray:
    """Tables of the hot cells after sweep ``sweep + 1``; their words are hot, so the totals say all about them."""
    c, tables = t.hot_customers[sweep], hot_root_tables(t, sweep, params)
    root = t.root_tables[sweep - 1] if sweep else float(t.vocabulary)
    parent = (c - t.root_discount * tables + (params.strength + t.root_discount * root) / (t.vocabulary + 1)) / (params.strength + t.tables[sweep].sum())
    others = t.tables[sweep][hot.cell_context] - t.hot_cell_tables[sweep]
    return seat(t.hot_cell_count.astype(np.int64), params.strength + t.discount * others, t.discount, parent[hot.cell_word],
                np.random.default_rng([params.seed, sweep, 4]))


TOTAL_ROWS = "what int, key int, value double"
CONTEXT_COUNT, TABLES, HOT_COUNT, HOT_CUSTOMERS, HOT_CELL_COUNT, SCALAR = range(6)


def _total_batch(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    what = np.concatenate([np.full(len(v), w, np.int32) for w, v in parts])
    key = np.concatenate([np.arange(len(v), dtype=np.int32) for _, v in parts])
    value = np.concatenate([v.astype(np.float64) for _, v in parts])
    some = value != 0
    return pa.RecordBatch.from_arrays([pa.array(what[some]), pa.array(key[some]), pa.array(value[some])], ["what", "key", "value"])


def _columns(batch: pa.RecordBatch, k: int) -> dict[str, pa.Buffer]:
    return {c: batch.column(c)[k].as_buffer() for c in batch.schema.names if c in STATE}


def _sweep_totals(hot: Hot, totals: Totals | None, sweep: int, params: LmParams):
    """Totals of all buckets after ``sweep`` sweeps; the first call counts the corpus."""
    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b = Bucket(batch.column("bucket")[k].as_py(), _columns(batch, k), totals or Totals(), params)
                parts = []
                if totals is None:
                    cells = np.bincount(b.word, weights=b.count > 0, minlength=len(b.word_count))
                    own, cold = ~b.hot, ~b.in_hot
                    parts.append((HOT_CELL_COUNT, np.bincount(b.cell_hot[b.in_hot], weights=b.count[b.in_hot], minlength=len(hot.cell_word))))
                    parts.append((CONTEXT_COUNT, np.bincount(b.context, weights=b.count, minlength=CONTEXTS)))
                    parts.append((HOT_COUNT, np.bincount(b.word_hot[b.hot], weights=b.word_count[b.hot], minlength=len(hot.words))))
                    parts.append((SCALAR, np.array([0.0, (own & (b.word_count > 0)).sum(), (cold & (b.count == 1)).sum(), (cold & (b.count == 2)).sum(),
                                                    (own & (cells == 1)).sum(), (own & (cells == 2)).sum()])))
                else:
                    while b.sweep < sweep - 1:
                        b.reseat()
                    if sweep:
                        parts.append((SCALAR, np.array([b.root()[1][~b.hot].sum()])))
                        if sweep <= params.sweeps:
                            b.reseat()
                parts.append((TABLES, b.tables_by_context()))
                parts.append((HOT_CUSTOMERS, np.bincount(b.word_hot[b.hot], weights=b.customers()[b.hot], minlength=len(hot.words))))
                yield _total_batch(parts)
    return run


def _collect_totals(buckets: DataFrame, run, hot: Hot) -> dict[int, np.ndarray]:
    size = {CONTEXT_COUNT: CONTEXTS, TABLES: CONTEXTS, HOT_COUNT: len(hot.words), HOT_CUSTOMERS: len(hot.words),
            HOT_CELL_COUNT: len(hot.cell_word), SCALAR: 8}
    got = {w: np.zeros(n) for w, n in size.items()}
    # at most 2 CONTEXTS rows and a few for each hot word and cell, whatever the corpus
    for r in buckets.mapInArrow(run, TOTAL_ROWS).groupBy("what", "key").agg(F.sum("value").alias("value")).collect():
        got[r["what"]][r["key"]] = r["value"]
    return got


def train(buckets: DataFrame, hot: Hot, params: LmParams) -> Totals:
    """Run the sweeps; returns the totals from which all seatings can be replayed."""
    cells = buckets.select("bucket", "word_count", "word_hot", "word_cells", "cell_context", "cell_hot", "cell_count")
    got = _collect_totals(cells, _sweep_totals(hot, None, 0, params), hot)
    _, words, once, twice, root_once, root_twice = got[SCALAR][:6]
    estimate = lambda a, b: float(np.clip(a / (a + 2 * b), 0.05, 0.95)) if a else 0.5
    t = Totals(tokens=int(got[CONTEXT_COUNT].sum()), vocabulary=int(words + (got[HOT_COUNT] > 0).sum()),
               discount=estimate(once, twice), root_discount=estimate(root_once, root_twice),
               context_count=got[CONTEXT_COUNT], hot_count=got[HOT_COUNT], hot_cell_count=got[HOT_CELL_COUNT])

    def add(tables: np.ndarray, customers: np.ndarray, of_hot_cells: np.ndarray) -> None:
        """A sweep's totals: those of the buckets, and the hot cells, which are in no bucket's sums."""
        t.tables.append(tables + np.bincount(hot.cell_context, weights=of_hot_cells, minlength=CONTEXTS))
        t.hot_customers.append(customers + np.bincount(hot.cell_word, weights=of_hot_cells, minlength=len(hot.words)))
        t.hot_cell_tables.append(of_hot_cells)

    add(got[TABLES], got[HOT_CUSTOMERS], np.minimum(t.hot_cell_count, 1))
    for sweep in range(1, params.sweeps + 2):  # the last call only counts the parent's tables of the last seating
        got = _collect_totals(cells, _sweep_totals(hot, t, sweep, params), hot)
        of_hot_cells = reseat_hot_cells(t, sweep - 1, hot, params)
        t.root_tables.append(float(got[SCALAR][0] + hot_root_tables(t, sweep - 1, params).sum()))
        if sweep <= params.sweeps:
            add(got[TABLES], got[HOT_CUSTOMERS], of_hot_cells)
    return t


SCORED = "row long, n_tokens long, n_known long, base_score double, score double"


class _Sums:
    """What a task has scored of each document, added up over its buckets."""

    NAMES = ("n_tokens", "n_known", "base_score", "score")

    def __init__(self):
        self.row = np.zeros(0, np.int64)  # ascending
        self.values = [np.zeros(0) for _ in self.NAMES]

    def add(self, row: np.ndarray, *values: np.ndarray) -> None:
        """One bucket's sums, its rows ascending; they are added to those held, so no document is held twice."""
        rows = np.union1d(self.row, row)
        held, new = np.searchsorted(rows, self.row), np.searchsorted(rows, row)
        for k, v in enumerate(values):
            total = np.zeros(len(rows))
            total[held] = self.values[k]
            total[new] += v
            self.values[k] = total
        self.row = rows

    def size(self) -> int:
        return len(self.row)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.row), 100_000):
            values = (v[lo: lo + 100_000] for v in self.values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.row[lo: lo + 100_000]), *(pa.array(v.astype(np.int64) if n.startswith("n_") else v) for n, v in zip(self.NAMES, values))],
                ["row", *self.NAMES])
        self.__init__()


def _score(totals: Totals, params: LmParams):
    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            for k in range(batch.num_rows):
                columns = _columns(batch, k)
                b = Bucket(batch.column("bucket")[k].as_py(), columns, totals, params)
                x = {c: unsqueeze(columns[c], STATE[c]).astype(np.int64) for c in ("cell_records", "record_doc", "record_n", "doc_step")}
                mean = np.zeros(len(b.count))
                while b.sweep < params.sweeps:
                    b.reseat()
                    if b.sweep > params.burn_in:
                        mean += b.probabilities() / (params.sweeps - params.burn_in)
                word_count = b.word_count.astype(float)
                word_count[b.hot] = totals.hot_count[b.word_hot[b.hot]]
                base = np.log10((word_count + 1) / (totals.tokens + totals.vocabulary + 1))
                cell = _runs(x["cell_records"])
                n, doc, uid = x["record_n"], x["record_doc"], np.cumsum(x["doc_step"])
                add = lambda v: np.bincount(doc, weights=v, minlength=len(uid))
                sums.add(uid, add(n), add(n * (word_count > 0)[b.word[cell]]), add(n * base[b.word[cell]]), add(n * np.log10(mean)[cell]))
                if sums.size() > MERGE_DOCS:
                    yield from sums.flush()
        yield from sums.flush()
    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids = np.frombuffer(batch.column("doc_ids")[k].as_py(), "<i8")
            held = np.frombuffer(batch.column("held")[k].as_py(), "<u1")
            row = batch.column("first_row")[k].as_py() + np.arange(len(ids))
            # 2 marks a document without an id
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(ids, mask=held > 1), pa.array(held == 1)], ["row", "doc_id", "held_out"])


def gather_corpus(docs: DataFrame) -> tuple[DataFrame, Hot, int]:
    """The stored buckets and document names, the hot words and cells, and the bytes of text."""
    spark = docs.sparkSession
    doc_id = docs["doc_id"].cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"),
        F.when(doc_id.isNull(), 2).otherwise((F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2).cast("int")).alias("held_out"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_buckets = shuffle_width(spark, n_bytes, BUCKET_TEXT)
    hot = find_hot(rows, n_buckets)
    gathered = stored(rows.mapInArrow(_deal(hot, n_buckets), DEALT).groupBy("bucket").applyInPandas(_gather(hot), GATHERED), "lm-buckets")
    return gathered, hot, n_bytes


def score_corpus(docs: DataFrame, params: LmParams = LmParams()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    The model is learned from the documents whose ``crc32(doc_id as text) mod 7`` is not 2 and
    scores all of them; ``score`` is the log10 probability of the text with its end, ``base_score``
    that of add-one unigrams.

    Defined cases: null counts as the empty text, which is one end token; a null doc_id
    is learned from and returned as null; repeated rows are counted and returned each;
    with no document to learn from, all tokens are unknown and share the uniform
    probability; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    gathered, hot, n_bytes = gather_corpus(docs)
    buckets = gathered.where("kind = 1")
    totals = train(buckets, hot, params)
    # few large tasks: what a task has scored of a document is summed before the shuffle
    n_tasks = max(spark.sparkContext.defaultParallelism, -(-n_bytes // SCORE_TEXT))
    parts = buckets.select("bucket", *STATE).coalesce(n_tasks).mapInArrow(_score(totals, params), SCORED)
    sums = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    names = gathered.where("kind = 0").select("first_row", "doc_ids", "held").mapInArrow(_documents, "row long, doc_id long, held_out boolean")
    return names.join(sums, "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_pitman_yor_lm(spark, sf_dir):
    return score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"))
