"""Operator 9: near-duplicates by DartMinHash signatures and a banded join.

A document is a weighted set of five-word shingles. Darts are thrown into the plane
(element, weight, rank) by hashing: every unit cell holds a Poisson number of darts, the
same for every document. A document sees the darts whose weight lies under its
element's weight; per coordinate it keeps the dart of the earliest rank. About
``t ln t + 2t`` darts are needed for ``t`` coordinates whatever the document's size;
coordinates still empty are served by going to higher ranks. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity.

The join: equal texts are folded first. The texts of a bucket (one band key) meet one pivot,
never each other: candidates are verified exactly on their shingle sets, links are
contracted to components, and the pivot leaves the bucket, having met all of it. What
still holds several components after ``pivot_rounds`` is settled in blocks of bounded
size inside tasks, on bit sets, with one link returned for each pair of components. So
every two texts that share a band are compared or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.components import components
from wakeline.llm.tables import stored
from wakeline.llm.tokens import BASE, U64, give_back, mix, release, shingle_hashes, slices, words_of

#: cumulative probabilities of a Poisson number with mean 1
_POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 20.0)])))


#: documents signed at a time: each takes several hundred darts, however short it is
SIGNED_ROWS = 400


@dataclass(frozen=True)
class NearDupParams:
    shingle_words: int = 5
    similarity: float = 0.8
    bands: int = 25          # a pair at 0.8 shares no band with probability 2e-6
    rows_per_band: int = 4
    weighted: bool = True    # weights: occurrences of a shingle; else all are 1
    pivot_rounds: int = 2
    block_texts: int = 2048  # texts of a bucket that a task holds, twice


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * 2.0 ** -53


def dart_signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, t: int) -> np.ndarray:
    """Signatures (n_rows x t) of weighted sets given as distinct (row, element) with weights.

    Rows without an element keep zeros.
    """
    best = np.full(n_rows * t, np.iinfo(np.uint64).max, U64)
    out = np.zeros(n_rows * t, U64)
    total = np.bincount(row, weights=weight, minlength=n_rows)
    limit = (t * np.log(t) + 2 * t) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        use = np.flatnonzero(todo[row])
        ranks = np.ceil(limit[row[use]]).astype(np.int64)
        cells = ranks * np.ceil(weight[use]).astype(np.int64)
        pair = np.repeat(use, cells)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(cells) - cells, cells)
        rank_cell, weight_cell = nth % np.repeat(ranks, cells), nth // np.repeat(ranks, cells)
        with np.errstate(over="ignore"):
            seed = mix(element[pair] + mix((rank_cell.astype(U64) << U64(32)) + weight_cell.astype(U64), 21), 22)
        darts = np.searchsorted(_POISSON, _unit(seed), side="right")
        cell = np.repeat(np.arange(len(pair)), darts)
        nth = np.arange(len(cell)) - np.repeat(np.cumsum(darts) - darts, darts)
        with np.errstate(over="ignore"):
            dart = mix(seed[cell] + nth.astype(U64) * U64(BASE), 23)
        pair, rank_cell, weight_cell = pair[cell], rank_cell[cell], weight_cell[cell]
        fraction = mix(dart, 24)
        seen = (weight_cell + _unit(mix(dart, 25)) < weight[pair]) & (rank_cell + _unit(fraction) < limit[row[pair]])
        pair, dart, fraction, rank_cell = pair[seen], dart[seen], fraction[seen], rank_cell[seen]
        place = row[pair] * t + (mix(dart, 26) % U64(t)).astype(np.int64)
        rank = (rank_cell.astype(U64) << U64(44)) | (fraction >> U64(20))
        np.minimum.at(best, place, rank)
        first = rank == best[place]
        out[place[first]] = dart[first]
        todo &= (best.reshape(n_rows, t) == np.iinfo(np.uint64).max).any(axis=1)
        limit = limit * 2
    return out.reshape(n_rows, t)


def text_shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with occurrences; a text of 1 to ``size - 1`` words is one shingle."""
    words = words_of(column)
    h, row = shingle_hashes(words.hash, words.row, size)
    n_words = np.bincount(words.row, minlength=len(column))
    cut = np.concatenate([[0], np.cumsum(n_words)])
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    lone = np.zeros(len(short), U64)
    with np.errstate(over="ignore"):
        for k in range(size - 1):
            have = n_words[short] > k
            lone[have] = lone[have] * U64(BASE) + words.hash[cut[short[have]] + k] + U64(k + 1)
    row, h = np.concatenate([row, short]), np.concatenate([h, mix(lone, 27)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(row)))


def band_keys(signatures: np.ndarray, bands: int, rows_per_band: int) -> np.ndarray:
    keys = np.empty((len(signatures), bands), U64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(signatures), b + 1, U64)
            for k in range(b * rows_per_band, (b + 1) * rows_per_band):
                h = mix(h * U64(BASE) + signatures[:, k], 28)
            keys[:, b] = h
    return keys


def _sign(params: NearDupParams):
    @give_back
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", max_rows=SIGNED_ROWS):
            row, shingle, times = text_shingles(batch.column("text"), params.shingle_words)
            weight = times.astype(float) if params.weighted else np.ones(len(row))
            signature = dart_signatures(row, shingle, weight, batch.num_rows, params.bands * params.rows_per_band)
            keys = band_keys(signature, params.bands, params.rows_per_band).astype(np.int64)
            size = np.bincount(row, weights=weight, minlength=batch.num_rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, params.bands, 0))]).astype(np.int32)),
                pa.array(keys[size > 0].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("node"), pa.array(size.astype(np.int64)), lists],
                ["doc_id", "node", "n_shingles", "keys"])
    return sign


def _pack_sets(params: NearDupParams):
    @give_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, shingle, times = text_shingles(batch.column("text"), params.shingle_words)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sets = [shingle[a:b].astype("<u8").tobytes() for a, b in zip(cut[:-1], cut[1:])]
            counts = [times[a:b].astype("<u4").tobytes() if params.weighted else b"" for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.binary()), pa.array(counts, pa.binary())], ["node", "shingles", "times"])
    return pack


def _similarity(a: dict, b: dict, weighted: bool) -> float:
    x, y = np.frombuffer(a["shingles"], "<u8"), np.frombuffer(b["shingles"], "<u8")
    at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
    shared = y[at] == x if len(y) else np.zeros(len(x), bool)
    if not weighted:
        both = int(shared.sum())
        return both / (len(x) + len(y) - both)
    u, v = np.frombuffer(a["times"], "<u4").astype(np.int64), np.frombuffer(b["times"], "<u4").astype(np.int64)
    both = int(np.minimum(u[shared], v[at[shared]]).sum())
    return both / (u.sum() + v.sum() - both)


def _verify(params: NearDupParams):
    @give_back
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            left, right = batch.column("left"), batch.column("right")
            close = [_similarity(left[k].as_py(), right[k].as_py(), params.weighted) >= params.similarity
                     for k in range(batch.num_rows)]
            keep = pa.array(close, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])
    return verify


def _settle(params: NearDupParams):
    """One link for each two components of a block pair that some two of its texts connect."""
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        release()  # what the group before has left
        rows = rows.drop_duplicates("node").reset_index(drop=True)
        sets = [np.frombuffer(x, "<u8") for x in rows["shingles"]]
        m = len(sets)
        times = [np.frombuffer(x, "<u4").astype(np.int64) if params.weighted else np.ones(len(s), np.int64) for x, s in zip(rows["times"], sets)]
        size = np.array([int(t.sum()) for t in times])
        # a weight of k counts as k elements, so that overlaps are counts of common bits
        element = np.concatenate([np.repeat(s, t) for s, t in zip(sets, times)])
        nth = np.concatenate([np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t) for t in times])
        with np.errstate(over="ignore"):
            element = mix(element + nth.astype(U64) * U64(BASE), 29) if params.weighted else element
        owner = np.repeat(np.arange(m), size)
        _, bit, seen = np.unique(element, return_inverse=True, return_counts=True)
        common = seen > 1
        bit, owner = (np.cumsum(common) - 1)[bit[common[bit]]], owner[common[bit]]
        bits = np.zeros((m, -(-int(common.sum()) // 64) or 1), U64)
        np.bitwise_or.at(bits, (owner, bit >> 6), U64(1) << (bit & 63).astype(U64))
        block = rows["block"].to_numpy()
        component = np.unique(np.array([bytes(c) for c in rows["component"]], object), return_inverse=True)[1]
        largest = np.bincount(component).argmax()
        one_block = rows["lo"].iloc[0] == rows["hi"].iloc[0]
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for r in np.flatnonzero(component != largest).tolist():
            other = (component != component[r]) & (size >= params.similarity * size[r]) & (size * params.similarity <= size[r])
            other &= (np.arange(m) > r) | (component == largest) if one_block else block != block[r]
            at = np.flatnonzero(other)
            both = np.bitwise_count(bits[at] & bits[r]).sum(axis=1, dtype=np.int64)
            for k in at[both >= params.similarity * (size[at] + size[r] - both)].tolist():
                found.setdefault((int(component[r]), int(component[k])), (r, k))
        node = rows["node"]
        return pd.DataFrame({"a": [node[r] for r, _ in found.values()], "b": [node[k] for _, k in found.values()]}, columns=["a", "b"])
    return settle


class NearDuplicates:
    """The tables of one run: ``rows`` (document to text), ``texts`` (distinct texts), ``links``, ``groups``."""

    def __init__(self, docs: DataFrame, params: NearDupParams = NearDupParams()):
        self.params = params
        text = F.coalesce(docs["text"], F.lit(""))
        self.docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("node"),
                                text.alias("text"))
        self.rows = stored(self.docs.mapInArrow(
            _sign(params), "doc_id long, node binary, n_shingles long, keys array<long>"), "dart-rows")
        self.texts = stored(self.rows.groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")),
            "dart-texts")
        self.buckets = self._shared_buckets()
        self.sets = self._sets()
        self.groups = self._group()

    def _shared_buckets(self) -> DataFrame:
        """``key, node, n_shingles`` of the band keys that at least two different texts share."""
        rows = self.texts.select("node", "n_shingles", F.explode("keys").alias("key"))
        shared = rows.groupBy("key").count().where("count > 1").select("key")
        return stored(rows.join(shared, "key", "left_semi"), "dart-buckets")

    def _sized(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow the similarity at all."""
        return pairs.where(F.least("n_a", "n_b") >= self.params.similarity * F.greatest("n_a", "n_b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def _sets(self) -> DataFrame:
        """The shingle sets of all texts in shared buckets; each is fetched from the row of its first document."""
        nodes = self.buckets.select("node").distinct()
        first = self.texts.select("node", F.col("first_doc").alias("doc_id")).join(nodes, "node", "left_semi")
        fetched = self.docs.alias("d").join(
            first.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.node") == F.col("f.node")), "left_semi")
        packed = fetched.select("node", "text").mapInArrow(_pack_sets(self.params), "node binary, shingles binary, times binary")
        return stored(packed.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("times").alias("times")), "dart-sets")

    def _links(self, pairs: DataFrame) -> DataFrame:
        sets = self.sets.select("node", F.struct("shingles", "times").alias("set"))
        with_left = pairs.join(sets.withColumnsRenamed({"node": "a", "set": "left"}), "a")
        with_both = with_left.join(sets.withColumnsRenamed({"node": "b", "set": "right"}), "b")
        return with_both.select("a", "b", "left", "right").mapInArrow(_verify(self.params), "a binary, b binary")

    def _still_open(self, rows: DataFrame, groups: DataFrame) -> DataFrame:
        """Rows with their components as of now, in the buckets that hold several."""
        # stored: the aggregate then sums up in each task before its shuffle, whatever joined the rows
        labelled = stored(rows.select("key", "node", "n_shingles").join(groups, "node", "left").select(
            "key", "node", "n_shingles", F.coalesce("component", "node").alias("component")), "dart-labelled")
        mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        return stored(labelled.join(mixed.select("key"), "key", "left_semi"), "dart-open")

    def _group(self) -> DataFrame:
        """``node, component`` of the texts that have a link."""
        groups = self.docs.sparkSession.createDataFrame([], "node binary, component binary")
        rows = self.buckets.withColumn("component", F.col("node"))
        for round_ in range(self.params.pivot_rounds):
            order = F.xxhash64("node", F.lit(round_)) if round_ else F.lit(0).cast("long")
            pivots = stored(rows.groupBy("key").agg(
                F.min(F.struct(order.alias("o"), "node", "component", "n_shingles")).alias("p")), "dart-pivots")
            met = rows.join(pivots, "key")
            pairs = stored(self._sized(met.where(F.col("component") != F.col("p.component")).select(
                F.col("node").alias("a"), F.col("p.node").alias("b"), F.col("n_shingles").alias("n_a"),
                F.col("p.n_shingles").alias("n_b"))), "dart-pairs")
            if not pairs.isEmpty():
                groups = self._merge(groups, stored(self._links(pairs), "dart-links"))
            rows = self._still_open(met.where(F.col("node") != F.col("p.node")), groups)
        if rows.isEmpty():
            return groups
        blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / self.params.block_texts).cast("int").alias("n"))
        dealt = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n")).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
            "key", "node", "component", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        links = dealt.join(self.sets, "node").groupBy("key", "lo", "hi").applyInPandas(_settle(self.params), "a binary, b binary")
        return self._merge(groups, stored(links, "dart-links"))

    @staticmethod
    def _merge(groups: DataFrame, links: DataFrame) -> DataFrame:
        """Groups after new links: components of the old components that the links join."""
        names = lambda side: groups.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        edges = links.join(names("a"), "a", "left").join(names("b"), "b", "left").select(
            F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
        merged = components(edges).withColumnsRenamed({"node": "old", "component": "new"})
        old = groups.withColumnRenamed("component", "old").join(merged, "old", "left").select("node", F.coalesce("new", "old").alias("component"))
        fresh = merged.join(groups.select(F.col("node").alias("old")), "old", "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
        return stored(old.unionByName(fresh), "dart-groups")

    def classes(self) -> DataFrame:
        """``doc_id, class_id, class_texts`` of every document row."""
        named = self.texts.select("node", "first_doc").join(self.groups, "node", "left").select(
            "node", "first_doc", F.coalesce("component", "node").alias("component"))
        # stored: a class with very many texts can then be split in the join, or its head broadcast
        heads = stored(named.groupBy("component").agg(F.min("first_doc").alias("class_id"), F.count("*").alias("class_texts")), "dart-heads")
        by_text = stored(named.join(heads, "component").select("node", "class_id", "class_texts"), "dart-classes")
        return self.rows.select("doc_id", "node").join(by_text, "node").select("doc_id", "class_id", "class_texts", "node")


def near_duplicate_classes(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """``doc_id, class_id, class_texts``: the class of every document.

    Documents are in one class when a chain of links (weighted Jaccard similarity of the shingles,
    each weighing as much as it occurs, at least ``similarity``, or equal texts) joins them; ``class_id`` is the smallest doc_id of the
    class, ``class_texts`` the number of its different texts.

    Defined cases: null counts as the empty text; texts without a word form one class per
    distinct text; texts under five words are compared as one shingle; repeated rows are
    returned each; a null doc_id is named only when a class has no other; an empty
    table gives an empty result; other columns are ignored.
    """
    return NearDuplicates(docs, params).classes().drop("node")


def one_per_class(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """``docs`` with one row of each class: that of its ``class_id``; of repeated rows one stays.

    Defined cases: as in :func:`near_duplicate_classes`; a null doc_id stays where its class has no other;
    all columns stay as they are, whatever their names; an empty table gives an empty result.
    """
    key = lambda c: F.coalesce(c.cast("long"), F.lit(-(1 << 63)))  # noqa: E731  null doc_ids are one key
    named = NearDuplicates(docs, params).classes()
    first = named.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(key(F.col("class_id")).alias("_near_dup_id"), "node")
    heads = first.groupBy("_near_dup_id").agg(F.min("node").alias("_near_dup_node"))  # a doc_id may stand for several texts
    text = F.coalesce(docs["text"], F.lit(""))
    keyed = docs.withColumns({"_near_dup_id": key(docs["doc_id"]), "_near_dup_node": F.unhex(F.md5(text.cast("binary")))})
    return keyed.join(heads, ["_near_dup_id", "_near_dup_node"], "left_semi").dropDuplicates(["_near_dup_id", "_near_dup_node"]).select(*docs.columns)


def op9_dart_minhash(spark, sf_dir):
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
