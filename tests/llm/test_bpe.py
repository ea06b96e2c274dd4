"""Tree concatenation against the library on whole texts."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from tests.conftest import SF001
from wakeline.llm.bpe import FIRST_WINDOW, Encoder, bpe_tokens, encode_tree, op10_bpe_tree, unpack, vocabulary_path

PIECES = ["the ", "a", "B", "é", "é", "'s", "'re", "'", '"', "1", "23", " ", "\n", "  ", "<|endoftext|>", "<|", "|>", "!", "...", "中",
          "\U0001f600", "Σ", "word", "ing", "\x01", " ", "​", "한", "가", "x" * 7, "İ", "'ll", ".", "don't"]


@pytest.fixture(scope="module")
def enc():
    return Encoder(vocabulary_path())


def whole(enc, text):
    return enc.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(enc, seed):
    rng = random.Random(seed)
    for _ in range(700):
        pool = rng.sample(PIECES, rng.choice([3, 8, len(PIECES)]))
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 120)))
        ids = whole(enc, text)
        assert encode_tree(enc, text, rng.choice([1, 3, 10, 40])) == ids, text
        packed, decoded = enc.leaf_and_text(text)
        assert unpack(packed).tolist() == ids and decoded.decode() == enc.decode(ids)


def test_unsplit_text(enc):
    rng = random.Random(9)
    for alphabet in ("a", "ab", "abcdefgh", "aé中"):
        text = "".join(rng.choice(alphabet) for _ in range(5000))
        assert encode_tree(enc, text, 300) == whole(enc, text)


def test_joins_encode_windows_only(enc, monkeypatch):
    """Characters that all joins of an unsplit text encode anew: a few windows each, whatever the text's size."""
    rng = random.Random(4)
    seen = []
    spans = enc.spans
    monkeypatch.setattr(enc, "spans", lambda text: seen.append(len(text)) or spans(text))
    for size in (1 << 16, 1 << 18, 1 << 20):
        text = "".join(rng.choice("abcdefgh") for _ in range(size))
        seen.clear()
        assert encode_tree(enc, text, 4096) == whole(enc, text)
        joins = size // 4096 - 1
        assert sum(seen) <= joins * 8 * FIRST_WINDOW and max(seen) <= 32 * FIRST_WINDOW


def row_of(enc, doc_id, text):
    ids = whole(enc, text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(enc.decode(ids).encode()).hexdigest())


def test_query(spark, enc):
    rows = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    assert sorted(tuple(r) for r in op10_bpe_tree(spark, SF001).collect()) == sorted(row_of(enc, *r) for r in rows)


def test_pieces_of_long_texts_over_the_cluster(spark, enc, edge_docs, wide_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = sorted(str((i, whole(enc, t or ""))) for i, t in rows)
    for leaf in (500, 32_768):
        got = bpe_tokens(edge_docs, vocabulary_path(), leaf).collect()
        assert sorted(str((r.doc_id, unpack(r.ids).tolist())) for r in got) == want
    assert bpe_tokens(wide_docs, vocabulary_path(), 500).count() == len(rows)
    assert bpe_tokens(no_docs, vocabulary_path()).count() == 0


def test_new_words_are_decoded_in_one_call(monkeypatch):
    """Single calls per word were a fifth of the time of a leaf."""
    from wakeline.llm.bpe import MARK, Encoder, unpack, vocabulary_path

    enc = Encoder(vocabulary_path())
    monkeypatch.setattr(Encoder, "decode", lambda *_: 1 / 0)
    for text in ("", " \n", "one Two three", f"a{MARK}b c {MARK} d", "naïve ́é 日本語 \U0001f600 x1234 don't", MARK, "​ ﻿"):
        ids, decoded = enc.leaf_and_text(text)
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert unpack(ids).tolist() == want
        assert decoded.decode() == enc.tokenizer.decode(want, skip_special_tokens=False)


def test_packed_tokens_come_back_and_compress():
    import zlib

    import numpy as np

    from wakeline.llm.bpe import pack_tokens, unpack_tokens

    rng = np.random.default_rng(3)
    start = np.cumsum(rng.integers(0, 6, 20_000))
    tokens = np.stack([rng.integers(0, 49_000, 20_000), start, start + rng.integers(0, 9, 20_000)], axis=1)
    assert np.array_equal(unpack_tokens(pack_tokens(tokens)), tokens)
    assert unpack_tokens(pack_tokens(tokens[:0])).shape == (0, 3)
    assert len(zlib.compress(pack_tokens(tokens))) < 0.7 * len(zlib.compress(tokens.astype("<i4").tobytes()))


def test_a_batch_looks_each_distinct_word_up_once(monkeypatch):
    """Look-ups of every word were two fifths of the time of a leaf."""
    import pyarrow as pa

    enc, seen = Encoder(vocabulary_path()), []
    known = Encoder._known
    monkeypatch.setattr(Encoder, "_known", lambda self, words: seen.extend(words) or known(self, words))
    texts = ["one Two\tone\x0bTwo\x0cthree\r\n", "", " \n", "a\x1cb\x85c d e f\x00g", "<|endoftext|> one<|EndOfText|>", "\x01 Two \x01x"] * 50
    ids, decoded = enc.leaves(pa.array(["left out", *texts]).slice(1))
    want = [whole(enc, t) for t in texts]
    assert [unpack(x).tolist() for x in ids.to_pylist()] == want
    assert decoded.to_pylist() == [enc.decode(x) for x in want]
    assert sorted(seen) == sorted({w for t in texts for w in re.split("[ \t\n\x0b\x0c\r]+", t)})


def test_words_that_outgrow_the_memo_are_learned_again(monkeypatch):
    import pyarrow as pa

    from wakeline.llm import bpe

    monkeypatch.setattr(bpe, "MEMO_WORDS", 5)
    enc = Encoder(vocabulary_path())
    texts = [" ".join(f"w{(i * j) % 17}" for j in range(9)) for i in range(60)]
    for k in range(0, 60, 3):
        ids, decoded = enc.leaves(pa.array(texts[k:k + 3]))
        assert [unpack(x).tolist() for x in ids.to_pylist()] == [whole(enc, t) for t in texts[k:k + 3]]
        assert decoded.to_pylist() == [enc.decode(whole(enc, t)) for t in texts[k:k + 3]]
