"""The interleaved copy: same rows, and row groups skipped for filters on each of its columns."""

import datetime as dt
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wakeline.session import scratch_path
from wakeline.sources.interleave import interleaved, rank_bounds, write_interleaved
from wakeline.sources.tables import write_stage

START = dt.datetime(2026, 4, 18)


def _gaps(spark, n=4_000, hot=0.4):
    rng = random.Random(4)
    rows = [(i, 219000000 + (0 if rng.random() < hot else rng.randrange(60)), START + dt.timedelta(seconds=rng.randrange(7 * 86_400)),
             int(rng.paretovariate(1.1) * 1000)) for i in range(n)]
    rows += [(n, None, None, None), (n + 1, 219000000, None, 5)]
    return write_stage(spark.createDataFrame(rows, "row_id bigint, mmsi bigint, ts timestamp_ntz, delta_t_ms bigint"), "gaps"), rows


def _overlapping(files, column, low, high):
    """Files whose minimum and maximum do not rule the filter out, and all of them."""
    hit = 0
    for f in files:
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        k = [meta.schema.column(j).name for j in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
        hit += any(s is not None and s.has_min_max and s.min <= high and s.max >= low for s in stats)
    return hit, len(files)


def test_each_filter_skips_files(spark):
    df, rows = _gaps(spark)
    path = scratch_path(spark, "interleaved")
    write_interleaved(df, path, rows_per_file=60)
    back = spark.read.parquet(path)
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, rows))
    files = back.inputFiles()
    longest = sorted(r[3] for r in rows if r[3])[-40]
    for column, low, high in (("mmsi", 219000030, 219000030), ("ts", START + dt.timedelta(days=3), START + dt.timedelta(days=3, hours=4)),
                              ("delta_t_ms", longest, 1 << 60)):
        hit, n = _overlapping(files, column, low, high)
        assert n > 50 and hit < 0.45 * n, (column, hit, n)
    plan = back.where(F.col("delta_t_ms") > longest)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(delta_t_ms" in plan


def test_bits_are_taken_in_turn(spark):
    rows = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").withColumn("z", interleaved([F.col("a"), F.col("b")], 3))
    for r in df.collect():
        want = sum((r.a >> k & 1) << 2 * k + 1 | (r.b >> k & 1) << 2 * k for k in range(3))
        assert r.z == want


def test_equal_values_are_dealt_over_files(spark):
    df = write_stage(spark.range(1000).select(F.col("id").alias("row_id"), F.lit(7).cast("bigint").alias("mmsi"),
                                              F.lit(START).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("bigint").alias("delta_t_ms")), "equal")
    path = scratch_path(spark, "interleaved-equal")
    write_interleaved(df, path, rows_per_file=100)
    sizes = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in spark.read.parquet(path).inputFiles()]
    assert sum(sizes) == 1000 and max(sizes) < 250
    assert rank_bounds(df, ["delta_t_ms"]) == [[]]


def test_empty_table(spark):
    df, _ = _gaps(spark, 0)
    path = scratch_path(spark, "interleaved-empty")
    write_interleaved(write_stage(df.where("false"), "none"), path)
    assert spark.read.schema(df.schema).parquet(path).count() == 0
