"""Operator 10: exact byte-pair encoding of whole texts by tree concatenation, and decoding.

A text up to the leaf size is one leaf. A longer text is halved until the pieces fit;
the pieces of all texts are dealt out over the cluster and encoded in parallel, then
joined pairwise up the tree. At a join only a window around the seam is encoded anew;
it grows until its tokens agree with the stored tokens of both sides, which keep their places
in the text, so the joined tokens are those of the unsplit text.

When do they agree? A token with the same id and the same characters in the window and
in the side is a common token. White space ends it in the text: the vocabulary's
pre-tokenizer never looks across white space, so one common token there settles the
side. Inside unsplit text several common tokens in a row are asked for, since BPE's
result is fixed by its neighbouring pairs. A window that has grown over a whole side
settles that side in any case.

Leaves take each distinct white-space separated word through the library once and keep
its ids, while the task runs, in a memo of two bounded generations: no step of the tokenizer looks across ASCII white space.
Arrow numbers the distinct words of a batch, so the memo is asked once a batch for each, and joins the tokens' texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tokens import give_back, slices

WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
SPACES = " \t\n\x0b\x0c\r"
MARK = "\x01"
LEAF_CHARS = 32_768
SUBTREE = 16                 # leaves joined in one task
FIRST_WINDOW = 32
AGREEING = 4
MEMO_WORDS = 250_000


def _pack(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def unpack(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4").astype(np.int64)


@lru_cache(maxsize=4)
def vocabulary(path: str):
    """The library's tokenizer, loaded once in a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def _token_names(path: str) -> pa.Array:
    """The text of every token, by id."""
    names = {i: name for name, i in vocabulary(path).get_vocab(with_added_tokens=True).items()}
    return pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())


def _spans_of(encoding) -> np.ndarray:
    out = np.empty((len(encoding.ids), 3), np.int64)
    if len(encoding.ids):
        out[:, 0] = encoding.ids
        out[:, 1:] = encoding.offsets
    return out


class Encoder:
    """One vocabulary, and the words that a task has met."""

    def __init__(self, path: str):
        self.tokenizer = vocabulary(path)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.spelled: dict[str, bytes] = {}  # words of long texts, with the places of their tokens
        self.mark_id, = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        # without a decoder the library joins the tokens with spaces
        self.by_word = self.tokenizer.decoder is None
        if self.by_word:
            self.names = _token_names(path)

    def _known(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        found = list(map(self.words.get, words))
        if None in found:
            missing = {w for w, x in zip(words, found) if x is None}
            if len(self.words) + len(missing) > MEMO_WORDS:
                self.older, self.words = self.words, {}
            again = {w: self.older[w] for w in missing if w in self.older}
            new = self._learn(missing.difference(again))
            self.words |= again
            self.words |= new
            found = [(again[w] if w in again else new[w]) if x is None else x for w, x in zip(words, found)]
        return found

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Encode new words in one call, set apart by a mark that is a token of its own."""
        new = [w for w in words if MARK in w]
        found = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in new]
        packed = dict(zip(new, map(_pack, found)))
        rest = [w for w in words if MARK not in w]
        if rest:
            ids = np.asarray(self.tokenizer.encode_batch_fast([f" {MARK} ".join(rest)], add_special_tokens=False)[0].ids, "<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            data, lo, hi = ids.tobytes(), [0, *((marks + 1) * 4).tolist()], [*(marks * 4).tolist(), 4 * len(ids)]
            packed.update((w, data[i:j]) for w, i, j in zip(rest, lo, hi, strict=True))
        return packed

    def leaves(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Packed ids of each text, and what they decode to.

        Arrow splits a batch into words and numbers the distinct ones: each of them is looked up once a batch.
        """
        split = pc.ascii_split_whitespace(texts.cast(pa.string()))
        words = split.flatten().dictionary_encode()
        known = self._known(words.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(size) - size  # of each distinct word in all their ids
        at = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(size[at])])
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(first[at] - ends[:-1], size[at]) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy()]
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds * 4), pa.py_buffer(ids)])
        if self.by_word:
            return packed.cast(pa.binary()), pc.binary_join(pa.ListArray.from_arrays(bounds.astype(np.int32), self.names.take(pa.array(ids))), " ")
        return packed.cast(pa.binary()), pa.array([self.decode(ids[i:j].tolist()) for i, j in zip(bounds, bounds[1:])], pa.string())

    def leaf_and_text(self, text: str) -> tuple[bytes, bytes]:
        """Packed ids of one text and what they decode to, in UTF-8."""
        ids, decoded = self.leaves(pa.array([text], pa.string()))
        return ids[0].as_py(), decoded[0].as_py().encode()

    def leaf_spans(self, text: str) -> np.ndarray:
        """Rows (id, start, end) of the tokens of a text, word by word."""
        found = [(m[0], m.start()) for m in WORD.finditer(text)]
        missing = list({w for w, _ in found}.difference(self.spelled))
        if len(self.spelled) + len(missing) > MEMO_WORDS:
            self.spelled = {}
            missing = list({w for w, _ in found})
        for w, e in zip(missing, self.tokenizer.encode_batch(missing, add_special_tokens=False)):
            self.spelled[w] = _spans_of(e).astype("<i4").tobytes()
        known = [self.spelled[w] for w, _ in found]
        out = np.frombuffer(b"".join(known), "<i4").reshape(-1, 3).astype(np.int64)
        out[:, 1:] += np.repeat([at for _, at in found], [len(x) // 12 for x in known]).astype(np.int64)[:, None]
        return out

    def spans(self, text: str) -> np.ndarray:
        """Rows (id, start, end) of the tokens of ``text``, in characters."""
        return _spans_of(self.tokenizer.encode(text, add_special_tokens=False))

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def pack_tokens(tokens: np.ndarray) -> bytes:
    """Rows (id, start, end) as columns of ids, steps between starts and lengths: small numbers, which a shuffle compresses."""
    return np.stack([tokens[:, 0], np.diff(tokens[:, 1], prepend=0), tokens[:, 2] - tokens[:, 1]]).astype("<i4").tobytes()


def unpack_tokens(data: bytes) -> np.ndarray:
    ids, step, length = np.frombuffer(data, "<i4").reshape(3, -1).astype(np.int64)
    start = np.cumsum(step)
    return np.stack([ids, start, start + length], axis=1)


class Node(NamedTuple):
    """A text of the tree with its tokens: rows (id, start, end), in characters of the text."""

    text: str
    tokens: np.ndarray


def _common(side: np.ndarray, window: np.ndarray, text: str, offset: int, after: bool) -> tuple[int, int] | None:
    """A settled pair (row in side, row in window) of one and the same token.

    ``after``: the side lies left of the seam and the token must settle what
    follows it; else the side lies right and the token settles what precedes it.
    """
    # only the side's tokens that the window reaches, and one more at either end, are looked at
    lo = max(0, int(np.searchsorted(side[:, 1], offset)) - 1)
    hi = int(np.searchsorted(side[:, 1], offset + len(text), side="right")) + 1
    at = {token: k for k, token in enumerate(map(tuple, side[lo:hi].tolist()), lo)}
    rows = [(j, at.get(token)) for j, token in enumerate(map(tuple, window.tolist()))]

    def whole(tokens: np.ndarray, k: int) -> bool:
        """No part of the token's characters lies in the neighbour that it must settle."""
        if after:
            return k + 1 == len(tokens) or tokens[k + 1, 1] >= tokens[k, 2]
        return k == 0 or tokens[k - 1, 2] <= tokens[k, 1]

    run = 0
    # from the window's edge towards the seam: the first settled token wins
    for j, k in rows if after else reversed(rows):
        run = run + 1 if k is not None else 0
        if k is None or not whole(side, k) or not whole(window, j):
            continue
        edge = (window[j, 2] if after else window[j, 1] - 1) - offset
        if run >= AGREEING or (0 <= edge < len(text) and text[edge] in SPACES):
            return k, j
    return None


def join(enc: Encoder, left: Node, right: Node) -> Node:
    """The node of ``left.text + right.text``: only windows around the seam are encoded anew."""
    n, m = len(left.text), len(right.text)
    beyond = right.tokens + np.array([0, n, n])
    grow = FIRST_WINDOW
    while True:
        a, b = max(0, n - grow), min(m, grow)
        text = left.text[a:] + right.text[:b]
        window = enc.spans(text) + np.array([0, a, a])
        first = _common(left.tokens, window, text, a, True) if a else (0, 0)
        last = _common(beyond, window, text, a, False) if b < m else (len(beyond) - 1, len(window) - 1)
        if first is not None and last is not None and first[1] <= last[1] + 1:
            kept = left.tokens[:first[0]]
            return Node(left.text + right.text, np.concatenate([kept, window[first[1]: last[1] + 1], beyond[last[0] + 1:]]))
        grow *= 2


def tree_join(enc: Encoder, nodes: list[Node]) -> Node:
    """Join neighbouring nodes pairwise, level by level."""
    while len(nodes) > 1:
        nodes = [join(enc, *nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0]


def halves(text: str, leaf_chars: int) -> list[str]:
    parts = [text]
    while max(map(len, parts)) > leaf_chars:
        parts = [h for p in parts for h in (p[: len(p) // 2], p[len(p) // 2:])]
    return parts


def encode_tree(enc: Encoder, text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
    """Ids of one text by tree concatenation, all in this process."""
    return tree_join(enc, [Node(p, enc.leaf_spans(p)) for p in halves(text, leaf_chars)]).tokens[:, 0].tolist()


def bpe_tokens(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``doc_id, ids (little-endian u32), decoded`` of every document.

    Defined cases: a null text is encoded as an empty one; rows with a repeated or
    null doc_id are encoded each; a text without white space is halved like any
    other; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))

    @give_back
    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *enc.leaves(batch.column("text"))], ["doc_id", "ids", "decoded"])

    @give_back
    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for batch in slices(batches, "piece"):
            tokens = [pack_tokens(enc.leaf_spans(t)) for t in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.binary())], [*batch.schema.names, "tokens"])

    def joined(enc: Encoder, pieces: pd.DataFrame) -> Node:
        pieces = pieces.sort_values("part")
        return tree_join(enc, [Node(p, unpack_tokens(t)) for p, t in zip(pieces["piece"], pieces["tokens"])])

    def merge_subtree(pieces: pd.DataFrame) -> pd.DataFrame:
        node = joined(Encoder(path), pieces)
        head = pieces[["row", "doc_id", "part"]].iloc[:1].reset_index(drop=True)
        return head.assign(part=head["part"] // SUBTREE, piece=node.text, tokens=pack_tokens(node.tokens))

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        enc = Encoder(path)
        ids = joined(enc, pieces).tokens[:, 0].tolist()
        return pd.DataFrame({"doc_id": pieces["doc_id"].iloc[:1], "ids": [_pack(ids)], "decoded": [enc.decode(ids)]})

    schema = "doc_id long, ids binary, decoded string"
    size = F.length("text")
    short = rows.where(size <= leaf_chars).mapInArrow(encode_short, schema)
    # 2^depth equal parts: what halving until the parts fit comes to; a row's id is
    # taken before the shuffle, in the scan that also cuts its pieces
    depth = F.ceil(F.log2(size / F.lit(leaf_chars)))
    cut = lambda k: F.floor(k * size / F.pow(F.lit(2), "depth")).cast("int")
    pieces = (
        rows.where(size > leaf_chars)
        .withColumn("row", F.struct(F.monotonically_increasing_id().alias("n"), "doc_id"))
        .withColumn("depth", depth)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), "depth").cast("int") - 1)))
        .select("row", "doc_id", "part", F.substring("text", cut(F.col("part")) + 1, cut(F.col("part") + 1) - cut(F.col("part"))).alias("piece"))
    )
    node = "row struct<n:long,doc_id:long>, doc_id long, part int, piece string, tokens binary"
    encoded = pieces.repartition("row", "part").mapInArrow(encode_pieces, node)
    # the lower levels of one document's tree are joined in as many tasks as it has subtrees
    subtrees = encoded.groupBy("row", F.floor(F.col("part") / SUBTREE).alias("subtree")).applyInPandas(merge_subtree, node)
    return short.unionByName(subtrees.groupBy("row").applyInPandas(merge, schema))


VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op10_bpe_tree(spark, sf_dir):
    tokens = bpe_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
    return tokens.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
