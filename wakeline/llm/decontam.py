"""Operator 2: benchmark decontamination by spaced-seed hashing.

A mask such as ``110111`` hashes the tokens under its ones and ignores the others, so
a hit survives substituted tokens under the zeros. Masked hashes of all benchmark items
are joined with those of every document position; each hit names a diagonal (document
position minus item position), on which the item is laid over the document and
compared token by token.

An item leaks into a document where ``window`` consecutive item tokens (all of them in
a shorter item) stand in the document with at most ``allowed(length)`` substitutions.
The two masks find every such place: for 13 tokens with 2 substitutions and 8 to 12 tokens
with 1, some mask fits at some offset (the tests try all cases). Items under 8 tokens
must occur unchanged and are sought by a solid mask of their own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.tokens import BASE, U64, give_back, mix, slices, words_of

MASKS = ("11010011", "110111")
WINDOW = 13
SHORT = 8
BLOCK_TOKENS = 2_000_000
FILTER_BITS = 20

#: everything but ASCII letters and digits and bytes above ASCII separates tokens
NOT_TOKEN = np.ones(256, bool)
NOT_TOKEN[48:58] = NOT_TOKEN[65:91] = NOT_TOKEN[97:123] = NOT_TOKEN[128:] = False


def allowed(length: int) -> int:
    """Substitutions allowed in a compared window of ``length`` tokens: a fifth, in whole tokens."""
    return 2 if length >= WINDOW else 1 if length >= SHORT else 0


def masked_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash at every start, over the tokens under the ones of ``mask``."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.full(n, len(mask), U64)
    with np.errstate(over="ignore"):
        for k, c in enumerate(mask):
            if c == "1":
                h = h * U64(BASE) + tokens[k: k + n]
    return mix(h, 5)


class Seeds(NamedTuple):
    """A block of items: their tokens, and per mask the sorted hashes with (item, position)."""

    item_ids: list[int | None]
    tokens: list[np.ndarray]
    masks: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]


def build_seeds(ids: list[int | None], texts: list[str | None]) -> Seeds:
    words = words_of(pa.array(texts, pa.string()), NOT_TOKEN)
    cut = np.searchsorted(words.row, np.arange(len(ids) + 1))
    tokens = [words.hash[a:b] for a, b in zip(cut[:-1], cut[1:])]
    masks = {}
    short = sorted({len(t) for t in tokens if 0 < len(t) < SHORT})
    for mask in (*MASKS, *("1" * n for n in short)):
        solid = len(mask) if "0" not in mask else 0
        use = [k for k, t in enumerate(tokens) if (len(t) == solid if solid else len(t) >= SHORT)]
        hashes = [masked_hashes(tokens[k], mask) for k in use]
        if not use:
            continue
        h = np.concatenate(hashes)
        item = np.repeat(use, [len(x) for x in hashes])
        position = np.concatenate([np.arange(len(x)) for x in hashes])
        order = np.argsort(h, kind="stable")
        masks[mask] = (h[order], item[order], position[order])
    return Seeds(list(ids), tokens, masks)


def diagonals(tokens: np.ndarray, row: np.ndarray, seeds: Seeds) -> np.ndarray:
    """Distinct (document start of the item, item) pairs that some seed hit names."""
    found = []
    for mask, (hashes, item, position) in seeds.masks.items():
        h = masked_hashes(tokens, mask)
        if not len(h) or not len(hashes):
            continue
        present = np.zeros(1 << FILTER_BITS, bool)
        present[hashes >> U64(64 - FILTER_BITS)] = True
        at = np.flatnonzero(present[h >> U64(64 - FILTER_BITS)])
        at = at[row[at] == row[at + len(mask) - 1]]
        lo = np.searchsorted(hashes, h[at], side="left")
        n = np.searchsorted(hashes, h[at], side="right") - lo
        where = np.repeat(at, n)
        seed = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        # the row is kept: a start before the batch's first token still belongs to this row
        found.append(np.stack([where - position[seed], item[seed], row[where]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def compare(tokens: np.ndarray, first: int, last: int, start: int, item: np.ndarray) -> tuple[int, int, int] | None:
    """Lay ``item`` at ``start`` over document tokens ``[first, last)``.

    Returns the covered document span and its equal tokens, from all windows that
    pass; None where none does.
    """
    lo, hi = max(start, first), min(start + len(item), last)
    size = min(WINDOW, len(item))
    if hi - lo < size:
        return None
    same = tokens[lo:hi] == item[lo - start: hi - start]
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(sums[size:] - sums[:-size] >= size - allowed(len(item) if len(item) < WINDOW else WINDOW))
    if not len(good):
        return None
    a, b = int(good[0]), int(good[-1]) + size
    return lo + a, lo + b, int(sums[b] - sums[a])


def _item_blocks(benchmark: DataFrame) -> Iterator[Seeds]:
    """The benchmark in blocks of at most ``BLOCK_TOKENS`` words, read one after the other."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    for r in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        size += r["text"].count(" ") + 1
        if size >= BLOCK_TOKENS:
            yield build_seeds(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield build_seeds(ids, texts)


def _overlaps(column: pa.Array, seeds: Seeds) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(row, item) to the first word, end word and equal words of the item's best place in the text."""
    words = words_of(column, NOT_TOKEN)
    cut = np.searchsorted(words.row, np.arange(len(column) + 1))
    best: dict[tuple[int, int], tuple] = {}
    for start, item, row in diagonals(words.hash, words.row, seeds).tolist():
        first = int(cut[row])
        got = compare(words.hash, first, int(cut[row + 1]), start, seeds.tokens[item])
        if got:
            a, b, n = got
            score = (n, a - b, -a)
            if (row, item) not in best or best[row, item][0] < score:
                best[row, item] = score, (a - first, b - first, n)
    return {k: place for k, (_, place) in sorted(best.items())}


LEAKS = "doc_id long, item_id long, first_word int, end_word int, n_equal int, item_words int"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each (document, item) that overlap: the widest overlap's place and size.

    Items are a stated query set: they are held in blocks of bounded size, and each
    block meets all whole documents in one map pass, so no document is shuffled and
    an item that many documents contain makes no hot group.

    Defined cases: null texts and texts without a token match nothing; repeated document
    rows are reported each; repeated item rows count once; items with equal texts but
    different ids are all reported; an empty table on either side gives an empty
    result; other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

    def finder(seeds: Seeds):
        @give_back
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[row], seeds.item_ids[item], *place, len(seeds.tokens[item]))
                       for (row, item), place in _overlaps(batch.column("text"), seeds).items()]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "first_word", "end_word", "n_equal", "item_words"), r)) for r in out],
                    schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *((c, pa.int32()) for c in (
                        "first_word", "end_word", "n_equal", "item_words"))]))
        return find

    found = spark.createDataFrame([], LEAKS)
    for seeds in _item_blocks(benchmark):
        found = found.unionByName(rows.mapInArrow(finder(seeds), LEAKS))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that any item leaks into; all columns stay as they are.

    Defined cases: null texts, and texts without a token, stay; repeated rows stay or go together; with no
    item, or none with a token, all rows stay; an empty table gives an empty result; further columns, whatever
    their names, pass through.
    """
    def keep(seeds: Seeds):
        @give_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                leaky = {row for row, _ in _overlaps(batch.column("text"), seeds)}
                yield batch.filter(pa.array([row not in leaky for row in range(batch.num_rows)], pa.bool_()))
        return run

    schema = docs.schema
    for seeds in _item_blocks(benchmark):
        docs = docs.mapInArrow(keep(seeds), schema)
    return docs


def op2_spaced_seed_leaks(spark, sf_dir):
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
