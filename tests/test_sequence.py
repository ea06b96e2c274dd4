"""The skew-safe previous-time operator against a plain window lag (brute force)."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF001
from wakeline.operators.sequence import ms_between, with_previous_time


def _brute(df, key, ts, order_id):
    w = Window.partitionBy(key).orderBy(ts, order_id)
    return df.withColumn("prev_ts", F.lag(ts).over(w))


def _rows(df, key, ts):
    return sorted((r[key], r[ts], r["row_id"], r["prev_ts"]) for r in df.select(key, ts, "row_id", "prev_ts").collect())


def _events_with_copies(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    base = ev.select(F.col("event_id").alias("row_id"), (F.col("user_id") % 7).alias("k"),
                     F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("t"))
    # copies: the same (k, t) again under new row ids, plus one key holding a third of the rows
    copies = base.filter(F.col("row_id") % 5 == 0).withColumn("row_id", F.col("row_id") + 100000)
    hot = base.withColumn("k", F.lit(99)).withColumn("row_id", F.col("row_id") + 200000).filter(F.col("row_id") % 2 == 0)
    return base.unionByName(copies).unionByName(hot)


def test_matches_window_lag_with_copies_and_small_ranges(spark):
    df = _events_with_copies(spark)
    for rows_per_range in (10, 200, 1_000_000):
        got = with_previous_time(df, key="k", ts="t", order_id="row_id", rows_per_range=rows_per_range)
        assert _rows(got, "k", "t") == _rows(_brute(df, "k", "t", "row_id"), "k", "t")


def test_microsecond_times(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("k"), F.col("ts").alias("t"))
    got = with_previous_time(ev, key="k", ts="t", order_id="row_id", rows_per_range=50)
    assert _rows(got, "k", "t") == _rows(_brute(ev, "k", "t", "row_id"), "k", "t")


def test_ranges_are_bounded_whatever_the_key(spark):
    """All rows of one key within one second: the lag's windows are still ranges of few rows."""
    df = spark.range(4000).select(F.col("id").alias("row_id"), F.lit(1).alias("k"),
                                  F.timestamp_micros(F.lit(1_776_000_000_000_000) + F.col("id") * 7).alias("t"))
    got = with_previous_time(df, key="k", ts="t", rows_per_range=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_part" in plan and "Bucketed: true" in plan and "hashpartitioning" not in plan
    ranges = spark.table(re.search(r"spark_catalog\.default\.(time_ranges_\w+)", plan).group(1)).groupBy("_part").count().collect()
    assert len(ranges) > 20 and max(r["count"] for r in ranges) < 400
    assert _rows(got, "k", "t") == _rows(_brute(df, "k", "t", "row_id"), "k", "t")


def test_ms_between_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.sql("SELECT TIMESTAMP_NTZ'2026-03-08 01:30:00' a, TIMESTAMP_NTZ'2026-03-08 03:30:00.123456' b") \
            .select(ms_between("a", "b").alias("d")).collect()[0]
        assert r.d == 2 * 3600 * 1000 + 123
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
