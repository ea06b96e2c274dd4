"""Placement by vessel: joins and counts leave the placed table where it is, and a large vessel lies in pieces."""

import datetime as dt

from pyspark.sql import functions as F

from wakeline.session import scratch_path
from wakeline.sources.buckets import counts_in_place, drop_placed, place_by_vessel, semi_join_in_place
from wakeline.sources.tables import write_stage


def _rows(spark, n=2_000):
    """Vessel 7 holds half of the rows; some rows have no vessel."""
    start = dt.datetime(2026, 4, 18)
    rows = [(i, 7 if i % 2 else None if i % 50 == 0 else 100 + i % 40, start + dt.timedelta(seconds=i)) for i in range(n)]
    return write_stage(spark.createDataFrame(rows, "row_id bigint, mmsi bigint, ts timestamp_ntz"), "placed-rows")


def test_semi_join_and_counts_shuffle_only_keys(spark):
    df = _rows(spark)
    placed = place_by_vessel(df, "placed_test", scratch_path(spark, "placed"), 8, 200)
    try:
        assert {(r.mmsi, r.pieces) for r in placed.large.collect()} == {(7, 5)}
        lying = {r.mmsi: r.n for r in placed.rows(spark).groupBy("mmsi").agg(F.count_distinct("piece").alias("n")).collect()}
        assert lying.pop(7) == 5 and set(lying.values()) == {1}
        assert sorted(map(str, placed.rows(spark).drop("piece").collect())) == sorted(map(str, df.collect()))
        keys = spark.createDataFrame([(7,), (102,), (7,), (5,), (None,)], "mmsi bigint")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = semi_join_in_place(placed, spark, keys)
        plan = got._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("Join"):]
        left = join[: join.index("Location")]  # down to the scan of the placed table, the first one in the plan
        assert "SortMergeJoin" in plan and "Exchange" not in left and "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1  # of the keys
        want = df.where("mmsi IN (7, 102)")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        counts = counts_in_place(placed, spark, F.col("row_id") >= 100)
        shuffles = counts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(mmsi")
        assert shuffles == 1
        assert sorted(map(str, counts.collect())) == sorted(map(str, df.where("row_id >= 100").groupBy("mmsi").agg(F.count("*").alias("n_reports")).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_placed(spark, placed)


def test_largest_file_is_bounded(spark):
    df = _rows(spark)
    path = scratch_path(spark, "placed-sizes")
    placed = place_by_vessel(df, "placed_sizes", path, 8, 100)
    try:
        sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == 2_000 and max(sizes) < 600  # unsplit, one file would hold 1,000 of one vessel
    finally:
        drop_placed(spark, placed)


def test_empty_table(spark):
    placed = place_by_vessel(write_stage(_rows(spark, 2).where("false"), "none"), "placed_none", scratch_path(spark, "placed-none"), 4, 10)
    try:
        assert semi_join_in_place(placed, spark, spark.createDataFrame([(7,)], "mmsi bigint")).count() == 0
    finally:
        drop_placed(spark, placed)
