"""Operator 3: contiguous shards of near equal byte size from global prefix sums.

Documents are put in doc_id order over range partitions. One small row per
partition (bytes, rows) gives each partition its global offset by a prefix sum;
a running sum inside the partition gives each document its global byte
interval, and the shard is the equal-sized target interval that holds the
interval's middle. So every cut is at most half a document away from its target.
Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.tables import shuffle_width, stored

ROWS_PER_RANGE = 1_000_000


def byte_shards(docs: DataFrame, n_shards: int, overhead: int = 8) -> DataFrame:
    """Shard every document by global byte prefix sums; law ``bytes``.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``:
    ``size`` is the UTF-8 length plus ``overhead``; shards are contiguous in
    (doc_id, input position) order, ``slot`` counts from 0 within a shard.

    Defined cases: a null text has length 0 and crc32 0; null doc_ids come
    first; rows with an equal doc_id (or entirely equal rows) each get a slot of
    their own, in input order; equal texts are separate documents; a document
    larger than the target sits alone on the cuts it spans, so shards between
    may be empty; an empty table gives an empty result; other columns are ignored.
    ``grown_shard`` is null: the law makes no promise when shards are added.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit(""))
    base = stored(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_pos"),
        ),
        "shard-base",
    )
    width = shuffle_width(spark, base.count(), ROWS_PER_RANGE)
    # written, because range bounds are sampled anew by each run of a plan
    ranged = stored(
        base.repartitionByRange(width, F.col("doc_id").asc_nulls_first(), F.col("_pos"))
        .withColumn("_part", F.spark_partition_id()),
        "shard-ranges",
    )
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    # one row per range partition: at most ``width`` rows, so the one-task window and the broadcast are bounded
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(F.col("doc_id").asc_nulls_first(), "_pos")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("_through", F.sum("size").over(running)).withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_part")
        # twice the middle of the document's byte interval, in whole numbers
        .withColumn("_mid2", 2 * (F.col("_bytes_before") + F.col("_through")) - F.col("size"))
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(f"(_mid2 * {n_shards}) div (2 * _total)")).cast("int"))
        .withColumn("_index", F.col("_rows_before") + F.col("_nth") - 1)
        .select("doc_id", "size", "text_crc32", "shard", "_index")
    )
    placed = stored(placed, "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_index") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


N_SHARDS = 24


def op3_byte_shards(spark, sf_dir):
    return byte_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), N_SHARDS)


# crc32 from its public definition: a 256-entry table by shifting the reversed
# polynomial, then one table step per byte of the text
OP3_SQL = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM (SELECT unnest(range(256)) AS i))),
base AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
placed AS (
  SELECT doc_id, size, h,
         CAST(((2 * sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size) * {N_SHARDS})
              // (2 * sum(size) OVER ()) AS INTEGER) AS shard
  FROM base)
SELECT doc_id, size,
       CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
                                         lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
                            lambda crc, b: xor(crc >> 8, tab[(xor(crc, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32,
       'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM placed, crc_table
"""
