"""Operator 11: importance resampling towards a target text distribution, on hashed features.

A feature (a run of words) falls into the bucket ``crc32(bytes) mod n_buckets``. The
target and the corpus are counted by bucket; a bucket's gain is the log ratio of its two
smoothed shares, a document's weight the sum of its features' gains, and a Gumbel draw
fixed by the doc_id turns weights into a sample without replacement.

Checksums are made for a batch's distinct features together: features of equal length
are the rows of one uint8 matrix, whose CRCs are updated column by column, and each
length's results are scattered back to the features' places.

Two passes read the texts: one counts buckets (one array of ``n_buckets`` sums per task),
one weighs documents. Only the bucket sums and, for the ranking, one short row per
document are shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.sql_text import CRC_TABLE, crc32_of, lowered
from wakeline.llm.tables import shuffle_width, stored
from wakeline.llm.tokens import give_back, slices, text_bytes, word_spans

#: separators: ASCII but digits and letters
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = True
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

POLYNOMIAL = 0xEDB88320
WORDS_PER_CHUNK = 1 << 18
#: longer features are few in a batch, so a matrix of them has more columns than rows: those go through zlib
LONGEST_COLUMN = 256
ROWS_PER_RANGE = 1_000_000


@dataclass(frozen=True)
class Resampling:
    n_buckets: int = 10_000
    max_run: int = 1        # features are runs of 1 to max_run words
    min_words: int = 20     # shorter documents are weighed but not drawn
    percent: int = 10       # of the documents that can be drawn
    seed: int = 2024


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


TABLE = _byte_table()


def crc32_all(features: pa.Array) -> np.ndarray:
    """The unsigned CRC-32 of every value of a binary column without nulls, by length-bucketed matrices."""
    data, offsets = _binary(features)
    size = np.diff(offsets)
    out = np.zeros(len(size), np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, members in zip(lengths.tolist(), np.split(order, first[1:])):
        if length == 0:
            continue  # the CRC of no bytes is 0
        if length > LONGEST_COLUMN:
            for k in members.tolist():
                out[k] = zlib.crc32(data[offsets[k]: offsets[k + 1]])
            continue
        matrix = data[offsets[members][:, None] + np.arange(length)]
        crc = np.full(len(members), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = (crc >> np.uint32(8)) ^ TABLE[(crc ^ column) & np.uint32(255)]
        out[members] = ~crc
    return out


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8),
            np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1])


def _features(column: pa.Array, max_run: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows and bytes of all features of the lower-cased texts, in chunks of bounded size."""
    data, offsets = text_bytes(column)
    start, end = word_spans(data, offsets, NOT_WORD)
    row = np.searchsorted(offsets, start, side="right") - 1
    for lo in range(0, len(start), WORDS_PER_CHUNK):
        hi = min(len(start), lo + WORDS_PER_CHUNK)
        stop = min(len(start), hi + max_run - 1)  # runs that start in the chunk may end past it
        part = LOWER[data[start[lo]: end[stop - 1]]]
        at, size = start[lo:stop] - start[lo], end[lo:stop] - start[lo:stop]
        inside = np.zeros(len(part) + 1, np.int8)
        inside[at] = 1
        np.subtract.at(inside, at + size, 1)
        packed = part[np.cumsum(inside[:-1]).astype(bool)]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), stop - lo, [None, pa.py_buffer(ends), pa.py_buffer(packed)])
        rows, runs = row[lo:stop], words.slice(0, hi - lo)
        yield rows[: hi - lo], runs
        for k in range(1, max_run):
            n = min(len(runs), stop - lo - k)
            if n <= 0:
                break
            runs = pc.binary_join_element_wise(runs.slice(0, n), words.slice(k, n), pa.scalar(b" ", pa.large_binary()))
            whole = rows[:n] == rows[k: k + n]
            yield rows[:n][whole], runs.filter(pa.array(whole))


def _buckets(column: pa.Array, params: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every feature; each distinct feature of a chunk is checksummed once."""
    for rows, runs in _features(column, params.max_run):
        if len(rows):
            distinct = pc.dictionary_encode(runs)
            crc = crc32_all(distinct.dictionary)
            yield rows, (crc % np.uint32(params.n_buckets)).astype(np.int64)[distinct.indices.to_numpy()]


def bucket_counts(texts: DataFrame, params: Resampling = Resampling()) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any (null text: none)."""

    @give_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.n_buckets, np.int64)
        for batch in slices(batches, "text"):
            for _, bucket in _buckets(batch.column("text"), params):
                total += np.bincount(bucket, minlength=params.n_buckets)
        bucket = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(bucket, pa.int64()), "n": pa.array(total[bucket], pa.int64())})

    parts = texts.select("text").mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(target: DataFrame, corpus: DataFrame, params: Resampling = Resampling()) -> np.ndarray:
    """Gain of every bucket, in thousandths: floor(1000 ln of target share over corpus share, each with one added).

    Both inputs are :func:`bucket_counts`: at most ``n_buckets`` rows reach the driver.
    """
    n = params.n_buckets
    t, s = [0] * n, [0] * n
    for seen, counts in ((t, target), (s, corpus)):
        for r in counts.collect():
            seen[r.bucket] = r.n
    all_t, all_s = sum(t), sum(s)
    return np.array([math.floor(1000 * math.log(float((t[b] + 1) * (all_s + n)) / float((s[b] + 1) * (all_t + n))))
                     for b in range(n)], np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, params: Resampling = Resampling()) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""

    @give_back
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            data, offsets = text_bytes(batch.column("text"))
            start, _ = word_spans(data, offsets, NOT_WORD)
            words += np.bincount(np.searchsorted(offsets, start, side="right") - 1, minlength=n)
            for rows, bucket in _buckets(batch.column("text"), params):
                features += np.bincount(rows, minlength=n)
                np.add.at(weight, rows, gains[bucket])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(words),
                                   "n_features": pa.array(features), "weight": pa.array(weight)})

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel_score(weight, doc_id, seed: int):
    """``weight`` plus a standard Gumbel draw in thousandths, fixed by seed and id (a null id counts as an empty one)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, params: Resampling = Resampling()) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; drawn documents have a rank.

    ``target`` is any table with a ``text`` column. Of the documents with at least
    ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn by score.

    Defined cases: a null or empty text has no features, weight 0 and is never drawn
    (unless ``min_words`` is 0); an empty target or corpus has shares from the smoothing
    alone; equal scores are ranked by doc_id, null first; rows with an equal
    doc_id each have a score of their own, equal rows are ranked in input order; an empty table gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(target, params), bucket_counts(docs, params), params)
    weighed = document_weights(docs, gains, params)
    scored = stored(weighed.withColumn("score", gumbel_score(F.col("weight"), F.col("doc_id"), params.seed))
                    .withColumn("_open", F.col("n_words") >= params.min_words)
                    .withColumn("_pos", F.monotonically_increasing_id()), "resample-scores")
    rows, n_open = scored.agg(F.count(F.lit(1)), F.count_if("_open")).first()
    drawn = n_open * params.percent // 100
    order = [F.col("_open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("_pos")]
    # written, because range bounds are sampled anew by each run of a plan
    ranged = stored(scored.repartitionByRange(shuffle_width(spark, rows, ROWS_PER_RANGE), *order)
                    .withColumn("_part", F.spark_partition_id()), "resample-ranges")
    # one row per range: a window and a broadcast of at most that many rows
    before = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    nth = (F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order))).cast("long")
    return ranged.join(F.broadcast(before), "_part").withColumn("_nth", nth).select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("_nth") <= drawn, F.col("_nth")).alias("rank"))


def op11_crc_resample(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return resample(read("documents"), read("benchmark"))


def _op11_sql(p: Resampling = Resampling()) -> str:
    words = f"regexp_extract_all({lowered("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, {words} AS ws FROM documents),
b AS (SELECT {words} AS ws FROM benchmark),
df AS (SELECT doc_id, unnest(ws) AS w FROM d),
bf AS (SELECT unnest(ws) AS w FROM b),
h AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM df UNION SELECT w FROM bf)),
crc AS (SELECT w, {crc32_of('x')} % {p.n_buckets} AS bucket FROM h, crc_table),
s AS (SELECT bucket, count(*) AS n FROM df JOIN crc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN crc USING (w) GROUP BY bucket),
gain AS (
  SELECT i AS bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM df) + {p.n_buckets}) AS DOUBLE)
         / CAST((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM bf) + {p.n_buckets}) AS DOUBLE))) AS BIGINT) AS g
  FROM range({p.n_buckets}) r(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
w AS (SELECT doc_id, sum(g) AS weight FROM df JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(w.weight, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('{p.seed}:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
final AS (
  SELECT doc_id, n_features, weight,
         weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM final WHERE n_features >= {p.min_words})
SELECT f.doc_id, f.n_features, f.weight, f.score,
       CASE WHEN r.r <= {p.percent} * r.n // 100 THEN r.r END AS rank
FROM final f LEFT JOIN ranked r ON r.doc_id = f.doc_id
"""


OP11_SQL = _op11_sql()
