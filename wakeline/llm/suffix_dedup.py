"""Operator 1: removal of repeated byte strings by suffix arrays over shards.

Every ``match``-byte string that also starts earlier is removed. Two equal strings share
their smallest ``gram``-byte hash (the anchor) at the same offset, so:

1. Every text is cut into segments: runs of string starts with one anchor. Equal segments
   of one batch are folded to the earliest before anything is shuffled.
2. Segments meet by anchor. An anchor that occurs once can hold no repeat. Equal segments
   are settled by their earliest occurrence; different segments of one anchor go on.
3. Their bytes are dealt into shards, an anchor's segments together. A shard's suffix array
   is built by induced sorting, and permuted common prefixes of ``match`` bytes mark the
   groups of equal strings; all but the earliest start of a group are repeats. An anchor
   with more than ``crowd`` different segments (the edge of a passage that very many documents
   hold) would make one large shard: its segments are split into their strings, which are
   dealt by two 64-bit hashes instead, folded per task like segments.
4. The repeats of a document are united and cut from its bytes.

Only bytes around anchors that recur are ever sorted, and all of them are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from wakeline.llm.suffix_array import permuted_common_prefixes, suffix_array
from wakeline.llm.tables import shuffle_width, stored
from wakeline.llm.tokens import BASE, U64, _powers, give_back, mix, release, slices, text_bytes

CHUNK = 1 << 20
PLACE = U64((1 << 24) - 1)
BYTE = mix(np.arange(256, dtype=U64), 41)
SECOND = mix(np.arange(256, dtype=U64), 43)
FLUSH = 500_000              # segments folded at a time by a task
BUCKET_BYTES = 48 << 20        # text per bucket of anchors
SHARD_BYTES = 3 << 19          # bytes per suffix array
NULL_ID = np.iinfo(np.int64).min


@dataclass(frozen=True)
class MatchParams:
    match: int = 100
    gram: int = 40
    crowd: int = 4_000


class Segments(NamedTuple):
    """Runs of string starts with one anchor: first byte, end byte, anchor and content hash."""

    start: np.ndarray
    end: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


_POW: list[np.ndarray] = []


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, CHUNK + 1024)
        _POW[:] = [_powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)]
    return _POW[0], _POW[1]


def _chunk_segments(data: np.ndarray, ends: np.ndarray, match: int, gram: int) -> Segments:
    """Segments of the strings that start in ``data[: -match + 1]``; ``ends``: per byte, its text's end."""
    n = len(data)
    power, inverse = _powers_for(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE[data] * power[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[: n + 1 - gram]) * inverse[: n + 1 - gram])
    least = (grams & ~PLACE) | np.arange(len(grams), dtype=U64)
    width, have = match - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have:])
    place = (least & PLACE).astype(np.int64)
    whole = np.arange(len(place)) + match <= ends[: len(place)]
    first = whole.copy()
    first[1:] &= (place[1:] != place[:-1]) | (ends[1: len(place)] != ends[: len(place) - 1]) | ~whole[:-1]
    last = whole.copy()
    last[:-1] &= (place[1:] != place[:-1]) | (ends[1: len(place)] != ends[: len(place) - 1]) | ~whole[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + match
    with np.errstate(over="ignore"):
        content = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64), 3)
    return Segments(start, end, grams[place[start]], content)


def segments_of(data: np.ndarray, offsets: np.ndarray, match: int, gram: int) -> Segments:
    """Segments of texts laid end to end, in chunks of bounded size."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    parts = []
    for lo in range(0, max(len(data) - match + 1, 0), CHUNK):
        hi = min(len(data), lo + CHUNK + match - 1)
        s = _chunk_segments(data[lo:hi], ends[lo:hi] - lo, match, gram)
        parts.append(Segments(s.start + lo, s.end + lo, s.anchor, s.content))
    if not parts:
        return Segments(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64))
    return Segments(*(np.concatenate(x) for x in zip(*parts)))


def _fold(doc: np.ndarray, doc_id: np.ndarray, start: np.ndarray, anchor: np.ndarray, content: np.ndarray):
    """Order by (anchor, content, doc_id, start); mark firsts of equal segments and those that start later.

    Occurrences at the very place of the first (a repeated row) are neither.
    """
    order = np.lexsort((start, doc_id[doc], content, anchor))
    a, c = anchor[order], content[order]
    first = np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])) if len(a) else np.zeros(0, bool)
    at = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(a) else np.zeros(0, np.int64)
    d, s = doc_id[doc[order]], start[order]
    later = (d != d[at]) | (s != s[at])
    return order, first, later


def _by_document(kind: int, doc: np.ndarray, doc_id: np.ndarray, text_key: np.ndarray, start: np.ndarray, end: np.ndarray,
                 group: np.ndarray | None = None, merge: bool = True) -> dict[str, list]:
    """One row per document with its spans packed; overlapping spans are united when ``merge``."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if merge and len(doc):
        far = (doc.astype(np.int64) << 33) + end  # ends rise within a document only after this shift
        reach = np.maximum.accumulate(far)
        new = np.append(True, (doc.astype(np.int64)[1:] << 33) + start[1:] > reach[:-1])
        at = np.flatnonzero(new)
        end = (np.maximum.reduceat(far, at) - (doc[at].astype(np.int64) << 33))
        doc, start = doc[at], start[at]
    cut = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc)) if len(doc) else np.zeros(1, np.int64)
    pieces = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
    start, end = start.astype("<u4"), end.astype("<u4")
    group = None if group is None else group[order].astype("<u8")
    of = doc[cut[:-1]]
    return {"kind": [kind] * len(pieces), "doc_id": doc_id[of].tolist(), "text_key": text_key[of].tolist(),
            "starts": [start[a:b].tobytes() for a, b in pieces], "ends": [end[a:b].tobytes() for a, b in pieces],
            "groups": [b"" if group is None else group[a:b].tobytes() for a, b in pieces]}


PACKED = ["anchors", "contents", "docs", "starts", "ends", "doc_ids", "text_keys"]
DEALT = "bucket int, kind int, doc_id long, text_key long, groups binary, " + ", ".join(f"{c} binary" for c in PACKED)
MATCHED = "kind int, doc_id long, text_key long, starts binary, ends binary, groups binary"
TYPES = {"anchors": "<u4", "contents": "<u8", "docs": "<u4", "starts": "<u4", "ends": "<u4", "doc_ids": "<i8", "text_keys": "<i8"}


class _Collector:
    """Segments of a task's texts, folded and packed per bucket when enough have come."""

    def __init__(self, n_buckets: int):
        self.n_buckets = n_buckets
        self.clear()

    def clear(self) -> None:
        self.ids, self.keys, self.parts, self.n_docs, self.n = [], [], [], 0, 0

    def add(self, ids: np.ndarray, keys: np.ndarray, s: Segments, offsets: np.ndarray) -> None:
        row = np.searchsorted(offsets, s.start, side="right") - 1
        self.parts.append((row + self.n_docs, s.start - offsets[row], s.end - offsets[row], s.anchor, s.content))
        self.ids.append(ids)
        self.keys.append(keys)
        self.n_docs += len(ids)
        self.n += len(row)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            self.clear()
            return
        doc, start, end, anchor, content = (np.concatenate(x) for x in zip(*self.parts))
        ids, keys = np.concatenate(self.ids), np.concatenate(self.keys)
        self.clear()
        order, first, later = _fold(doc, ids, start, anchor, content)
        gone = order[later]
        spans = _by_document(0, doc[gone], ids, keys, start[gone], end[gone])
        rows = [{"bucket": i % self.n_buckets, **{c: spans[c][i] for c in spans}} for i in range(len(spans["kind"]))]
        kept = order[~later]
        bucket = ((anchor[kept] >> U64(32)) % U64(self.n_buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        kept = kept[by]
        present, cut = np.unique(bucket[by], return_index=True)
        for b, part in zip(present.tolist(), np.split(kept, cut[1:])):
            used, local = np.unique(doc[part], return_inverse=True)
            packed = {"anchors": anchor[part] & U64(0xFFFFFFFF), "contents": content[part], "docs": local,
                      "starts": start[part], "ends": end[part], "doc_ids": ids[used], "text_keys": keys[used]}
            # numbers, not nulls: pandas would turn a column of longs with nulls into floats
            rows.append({"bucket": b, "kind": 2, "doc_id": 0, "text_key": 0, **{c: x.astype(TYPES[c]).tobytes() for c, x in packed.items()}})
        schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                            ("groups", pa.binary()), *((c, pa.binary()) for c in PACKED)])
        for lo in range(0, len(rows), 500):
            yield pa.RecordBatch.from_pylist(rows[lo: lo + 500], schema=schema)


def _deal_segments(params: MatchParams, n_buckets: int):
    @give_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Collector(n_buckets)
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            keys = batch.column("text_key").to_numpy(zero_copy_only=False).astype(np.int64)
            out.add(ids, keys, segments_of(data, offsets, params.match, params.gram), offsets)
            if out.n >= FLUSH:
                yield from out.flush()
        yield from out.flush()
    return deal


def _unpack(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """The packed rows of a bucket as arrays; ``docs`` then counts through all rows' documents."""
    got = {c: [np.frombuffer(x, TYPES[c]) for x in rows[c]] for c in PACKED}
    base = np.cumsum([0] + [len(x) for x in got["doc_ids"]])
    got["docs"] = [d.astype(np.int64) + b for d, b in zip(got["docs"], base)]
    return {c: np.concatenate(x) if x else np.zeros(0, TYPES[c]) for c, x in got.items()}


SPANS, WHOLE, STRINGS = 0, 1, 3  # kinds of rows: settled, segments to sort, segments to split into strings


def _meet_of(params: MatchParams):
    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        release()  # what the group before has left
        return _meet(rows, params.crowd)
    return meet


def _meet(rows: pd.DataFrame, crowd: int) -> pd.DataFrame:
    """One bucket: equal segments become spans, different segments of one anchor go on to the shards."""
    bucket = int(rows["bucket"].iloc[0])
    passed = rows.loc[rows["kind"] == 0, ["kind", "doc_id", "text_key", "starts", "ends", "groups"]]
    x = _unpack(rows[rows["kind"] == 2])
    start, end = x["starts"].astype(np.int64), x["ends"].astype(np.int64)
    order, first, later = _fold(x["docs"], x["doc_ids"], start, x["anchors"], x["contents"])
    gone = order[later]
    anchor = x["anchors"][order]
    group = np.cumsum(np.append(True, anchor[1:] != anchor[:-1])) - 1 if len(anchor) else np.zeros(0, np.int64)
    different = np.bincount(group, weights=first)[group] if len(group) else np.zeros(0)
    out = [passed, pd.DataFrame(_by_document(SPANS, x["docs"][gone], x["doc_ids"], x["text_keys"], start[gone], end[gone]))]
    for kind, of in ((WHOLE, (different > 1) & (different <= crowd)), (STRINGS, different > crowd)):
        go_on = ~later & of
        need, names = order[go_on], (anchor[go_on].astype(U64) << U64(32)) | U64(bucket)
        out.append(pd.DataFrame(_by_document(kind, x["docs"][need], x["doc_ids"], x["text_keys"], start[need], end[need], names, merge=False)))
    return pd.concat([f.astype({"doc_id": "int64", "text_key": "int64", "kind": "int32"}) for f in out], ignore_index=True)


def string_hashes(data: np.ndarray, length: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """All ``match``-byte strings of segments laid end to end: segment, offset in it, two hashes."""
    ends = np.cumsum(length)
    parts = []
    lo = 0
    while lo < len(length):
        base = int(ends[lo] - length[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
        part, own = data[base: int(ends[hi - 1])], length[lo:hi]
        power, inverse = _powers_for(len(part) + 1)
        n = np.maximum(own - match + 1, 0)
        segment = np.repeat(np.arange(len(own)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(own) - own)[segment] + offset
        hashes = []
        with np.errstate(over="ignore"):
            for values in (BYTE, SECOND):
                sums = np.zeros(len(part) + 1, U64)
                np.cumsum(values[part] * power[: len(part)], out=sums[1:])
                hashes.append(mix((sums[at + match] - sums[at]) * inverse[at], 5))
        parts.append((segment + lo, offset, *hashes))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*parts))


SHARD_PACKED = ["bytes", "lengths", "first", "second", "docs", "starts", "ends", "groups", "doc_ids", "text_keys"]
SHARDED = "shard int, kind int, doc_id long, text_key long, " + ", ".join(f"{c} binary" for c in SHARD_PACKED)


def _deal_bytes(params: MatchParams, n_shards: int):
    """Cut the wanted segments out of their texts and pack them per shard, or the hashes of their strings."""
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                        *((c, pa.binary()) for c in SHARD_PACKED)])

    def wanted_of(column: pa.Array) -> dict[str, np.ndarray]:
        parts = {"starts": [], "ends": [], "groups": [], "docs": [], "split": []}
        for row, wanted in enumerate(column.to_pylist()):
            for w in wanted:
                n = len(w["starts"]) // 4
                parts["starts"].append(np.frombuffer(w["starts"], "<u4").astype(np.int64))
                parts["ends"].append(np.frombuffer(w["ends"], "<u4").astype(np.int64))
                parts["groups"].append(np.frombuffer(w["groups"], "<u8"))
                parts["docs"].append(np.full(n, row))
                parts["split"].append(np.full(n, w["kind"] == STRINGS))
        return {c: np.concatenate(x) for c, x in parts.items()}

    def pack(kind: int, shard: np.ndarray, doc: np.ndarray, ids: np.ndarray, keys: np.ndarray, columns) -> Iterator[dict]:
        order = np.argsort(shard, kind="stable")
        present, cut = np.unique(shard[order], return_index=True)
        for k, part in zip(present.tolist(), np.split(order, cut[1:])):
            used, local = np.unique(doc[part], return_inverse=True)
            yield {"shard": k, "kind": kind, "doc_id": 0, "text_key": 0, "docs": local.astype("<u4").tobytes(),
                   "doc_ids": ids[used].astype("<i8").tobytes(), "text_keys": keys[used].astype("<i8").tobytes(), **columns(part)}

    @give_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            keys = batch.column("text_key").to_numpy(zero_copy_only=False).astype(np.int64)
            x = wanted_of(batch.column("wanted"))

            def cut_out(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                a, n = offsets[x["docs"][part]] + x["starts"][part], x["ends"][part] - x["starts"][part]
                return data[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())], n

            rows = []
            whole = np.flatnonzero(~x["split"])

            def segments(part: np.ndarray) -> dict:
                own, n = cut_out(whole[part])
                return {"bytes": own.tobytes(), "lengths": n.astype("<u4").tobytes(), "starts": x["starts"][whole[part]].astype("<u4").tobytes()}

            rows += pack(WHOLE, (mix(x["groups"][whole], 31) % U64(n_shards)).astype(np.int64), x["docs"][whole], ids, keys, segments)
            split = np.flatnonzero(x["split"])
            if len(split):
                segment, offset, one, two = string_hashes(*cut_out(split), params.match)
                doc, start = x["docs"][split[segment]], x["starts"][split[segment]] + offset
                order, _, later = _fold(doc, ids, start, one, two)
                gone, kept = order[later], order[~later]
                spans = _by_document(SPANS, doc[gone], ids, keys, start[gone], start[gone] + params.match)
                rows += [{"shard": i % n_shards, **{c: v[i] for c, v in spans.items()}} for i in range(len(spans["kind"]))]

                def strings(part: np.ndarray) -> dict:
                    at = kept[part]
                    return {"first": one[at].astype("<u8").tobytes(), "second": two[at].astype("<u8").tobytes(), "starts": start[at].astype("<u4").tobytes()}

                rows += pack(STRINGS, (mix(one[kept], 32) % U64(n_shards)).astype(np.int64), doc[kept], ids, keys, strings)
            for lo in range(0, len(rows), 500):
                yield pa.RecordBatch.from_pylist(rows[lo: lo + 500], schema=schema)
    return deal


def repeated_starts(data: np.ndarray, length: np.ndarray, key: np.ndarray, match: int) -> np.ndarray:
    """Positions in ``data`` (segments end to end) whose ``match`` bytes also start at a smaller key.

    ``key`` orders the places of all bytes: document first, then position.
    """
    ends = np.cumsum(length)
    n = int(ends[-1])
    segment = np.repeat(np.arange(len(length)), length)
    # a separator after each segment, one more than any byte; a zero ends the string
    spread = np.arange(n) + segment
    text = np.full(n + len(length) + 1, 256, np.uint16)
    text[spread] = data.astype(np.uint16) + 1
    text[text == 256] = 257
    text[spread] = data.astype(np.uint16) + 1
    text[-1] = 0
    order = suffix_array(text, 258)
    as_bytes = np.full(len(text), 0xFF, np.uint8)  # no byte of UTF-8
    as_bytes[spread] = data
    common = permuted_common_prefixes(as_bytes, order, match)
    at = np.full(len(text), -1, np.int64)
    at[spread] = np.where(np.arange(n) + match <= np.repeat(ends, length), np.arange(n), -1)
    group = np.cumsum(common[order] < match)
    position = at[order]
    whole = position >= 0
    position, group = position[whole], group[whole]
    if not len(position):
        return position
    new = np.append(True, group[1:] != group[:-1])
    least = np.minimum.reduceat(key[position], np.flatnonzero(new))[np.cumsum(new) - 1]
    return np.sort(position[key[position] > least])


def _shard_documents(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document and start of every packed entry, and the documents' ids and text keys."""
    start = np.concatenate([np.frombuffer(x, "<u4") for x in rows["starts"]]).astype(np.int64)
    ids = [np.frombuffer(x, "<i8") for x in rows["doc_ids"]]
    base = np.cumsum([0] + [len(x) for x in ids])
    doc = np.concatenate([np.frombuffer(x, "<u4").astype(np.int64) + b for x, b in zip(rows["docs"], base)])
    return doc, start, np.concatenate(ids), np.concatenate([np.frombuffer(x, "<i8") for x in rows["text_keys"]])


def _sorted_segments(rows: pd.DataFrame, match: int) -> dict[str, list]:
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    length = np.concatenate([np.frombuffer(x, "<u4") for x in rows["lengths"]]).astype(np.int64)
    doc, start, ids, keys = _shard_documents(rows)
    first = np.cumsum(length) - length
    rank = np.unique(ids, return_inverse=True)[1]
    segment = np.repeat(np.arange(len(length)), length)
    place = start[segment] + np.arange(len(data)) - first[segment]  # position in the document
    hits = repeated_starts(data, length, (rank[doc[segment]] << 32) + place, match)
    # neighbouring starts of one segment make one span
    new = np.append(True, (hits[1:] != hits[:-1] + 1) | (segment[hits[1:]] != segment[hits[:-1]])) if len(hits) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(hits)) - 1 if len(at) else at
    a, b = hits[at], hits[last]
    return _by_document(SPANS, doc[segment[a]], ids, keys, place[a], place[b] + match)


def _folded_strings(rows: pd.DataFrame, match: int) -> dict[str, list]:
    doc, start, ids, keys = _shard_documents(rows)
    one, two = (np.concatenate([np.frombuffer(x, "<u8") for x in rows[c]]) for c in ("first", "second"))
    order, _, later = _fold(doc, ids, start, one, two)
    gone = order[later]
    return _by_document(SPANS, doc[gone], ids, keys, start[gone], start[gone] + match)


def _sort_shard(params: MatchParams):
    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        release()
        out = [rows.loc[rows["kind"] == SPANS, ["kind", "doc_id", "text_key", "starts", "ends", "groups"]]]
        for kind, settle in ((WHOLE, _sorted_segments), (STRINGS, _folded_strings)):
            own = rows[rows["kind"] == kind]
            if len(own):
                out.append(pd.DataFrame(settle(own, params.match)))
        return pd.concat([f.astype({"doc_id": "int64", "text_key": "int64", "kind": "int32"}) for f in out], ignore_index=True)
    return sort


def remove_spans(data: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]]) -> tuple[bytes, int, np.ndarray]:
    """Kept bytes, number of maximal removed runs, and the mask of removed bytes."""
    depth = np.zeros(len(data) + 1, np.int64)
    for start, end in spans:
        np.add.at(depth, start, 1)
        np.add.at(depth, end, -1)
    gone = np.cumsum(depth[:-1]) > 0
    n_spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
    return data[~gone].tobytes(), n_spans, gone


@give_back
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        kept, n_removed, n_spans, texts = [], [], [], []
        for row, wanted in enumerate(batch.column("spans").to_pylist()):
            own = data[offsets[row]: offsets[row + 1]]
            spans = [(np.frombuffer(w["starts"], "<u4").astype(np.int64), np.frombuffer(w["ends"], "<u4").astype(np.int64))
                     for w in wanted or ()]
            rest, n, gone = remove_spans(own, spans)
            kept.append(rest)
            n_spans.append(n)
            n_removed.append(int(gone.sum()))
            # whole characters: one that is cut in part goes with its removed bytes
            texts.append(rest.decode("utf-8", "ignore"))
        rest = [c for c in batch.schema.names if c != "spans"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()),
             pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(texts, pa.string())],
            [*rest, "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text"])


def remove_repeats(docs: DataFrame, params: MatchParams = MatchParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_bytes, kept_text`` of every document, and its columns ``keep``.

    A byte is removed when a ``match``-byte string that covers it also starts earlier, in a
    document with a smaller doc_id or earlier in its own; strings are judged on the
    input. ``kept_text`` is ``kept_bytes`` without characters that were cut in part.

    Defined cases: null counts as the empty text; a null doc_id comes before all others;
    rows with an equal doc_id are read as one document, so an exactly repeated row
    loses nothing to its double; texts under ``match`` bytes keep everything; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit(""))
    order_id = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    rows = docs.select(order_id.alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    carried = [docs[c].alias(f"_carried_{c}") for c in keep]
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    long_rows = rows.where(F.octet_length("text") >= params.match)
    dealt = long_rows.mapInArrow(_deal_segments(params, shuffle_width(spark, n_bytes, BUCKET_BYTES)), DEALT)
    matches = stored(dealt.groupBy("bucket").applyInPandas(_meet_of(params), MATCHED), "suffix-matches")

    wanted = matches.where("kind <> 0").groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("kind", "starts", "ends", "groups")).alias("wanted"))  # a document's own segments
    n_wanted = matches.where("kind <> 0").agg(F.sum(F.octet_length("starts").cast("long"))).first()[0] or 0
    n_shards = shuffle_width(spark, n_wanted // 4 * (2 * params.match - params.gram), SHARD_BYTES)
    shards = long_rows.join(wanted, ["doc_id", "text_key"]).mapInArrow(_deal_bytes(params, n_shards), SHARDED)
    sorted_spans = shards.groupBy("shard").applyInPandas(_sort_shard(params), MATCHED)

    spans = matches.where("kind = 0").unionByName(sorted_spans).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("starts", "ends")).alias("spans"))
    whole = docs.select(order_id.alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"), *carried)
    joined = whole.join(spans, ["doc_id", "text_key"], "left")
    schema = StructType([*whole.schema, *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                         StructField("kept_bytes", BinaryType()), StructField("kept_text", StringType())])
    return joined.mapInArrow(_cut, schema).select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        "kept_bytes", "kept_text", *(F.col(f"_carried_{c}").alias(c) for c in keep))


def op1_suffix_dedup(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
