"""The day layout, appends and point lookups on it."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF01, SF001
from wakeline.operators.positions import positions_raw
from wakeline.operators.profile import vessel_reports
from wakeline.session import clear_scratch, scratch_path
from wakeline.sources.fixture import ais_strings
from wakeline.sources.tables import write_by_day, write_stage, write_table


def test_days_and_order_in_files(spark):
    raw = write_stage(positions_raw(ais_strings(spark, SF01)))
    path = scratch_path(spark, "layout")
    write_by_day(raw, path)
    back = spark.read.parquet(path)
    assert back.count() == raw.count()
    assert {r.day for r in back.select("day").distinct().collect()} == {dt.date(2026, 4, 18), dt.date(2026, 4, 19)}
    assert back.where(F.to_date("ts") != F.col("day")).count() == 0
    for f in [r.f for r in back.select(F.input_file_name().alias("f")).distinct().collect()]:
        rows = [(r.mmsi, r.ts, r.row_id) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows)


def test_file_sizes_follow_bytes_not_cores(spark):
    """With a small target size the rebalance makes more files, and a busy vessel is spread over several."""
    raw = write_stage(positions_raw(ais_strings(spark, SF01)).withColumn("mmsi", F.lit(219999999).cast("bigint")))
    files = {}
    for size in ("8k", "64m"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        try:
            path = scratch_path(spark, "layout-size")
            write_by_day(raw.repartition(8), path)
            files[size] = len(spark.read.parquet(path).inputFiles())
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert files["64m"] <= 2 < files["8k"]


def test_the_layout_reads_its_input_once(spark):
    raw = write_stage(positions_raw(ais_strings(spark, SF001)))
    plan = raw.withColumn("day", F.to_date("ts")).hint("rebalance", "day", "mmsi")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "REBALANCE" in plan


def test_point_lookup_is_pushed_to_the_scan(spark):
    path = scratch_path(spark, "layout-lookup")
    write_by_day(positions_raw(ais_strings(spark, SF001)), path)
    table = spark.read.parquet(path)
    target = table.agg(F.min("mmsi")).first()[0]
    q = vessel_reports(table, target, 5)
    assert "EqualTo(mmsi," in q._jdf.queryExecution().executedPlan().toString()  # pushed filter on the Parquet scan
    rows = q.collect()
    assert len(rows) == 5 and all(r.mmsi == target for r in rows)
    assert [(r.ts, r.row_id) for r in rows] == sorted((r.ts, r.row_id) for r in rows)


def test_append_adds_and_overwrite_replaces(spark):
    path = scratch_path(spark, "append")
    one, two = spark.range(3), spark.range(10, 12)
    write_table(one, path)
    write_table(two, path, mode="append")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 10, 11]
    write_table(two, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11]
    day = scratch_path(spark, "append-days")
    raw = write_stage(positions_raw(ais_strings(spark, SF001)))
    write_by_day(raw.where("row_id % 2 = 0"), day)
    write_by_day(raw.where("row_id % 2 = 1"), day, mode="append")
    assert spark.read.parquet(day).count() == raw.count()


def test_scratch_tables_are_cleared(spark, tmp_path, monkeypatch):
    import wakeline.session as session

    monkeypatch.setattr(session, "_SCRATCH", [])
    stage = write_stage(spark.range(5), "cleared")
    folder = stage.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    import os

    assert os.path.isdir(folder)
    assert clear_scratch(spark) == 1 and not os.path.exists(folder)


def test_file_profile_reads_no_data_column(spark):
    from wakeline.operators.profile import file_profile
    from wakeline.plans.jobs import build_stages
    from wakeline.sources.fixture import ais_strings
    from tests.conftest import SF001

    path = scratch_path(spark, "file-profile")
    write_by_day(build_stages(ais_strings(spark, SF001)).raw, path)
    df = spark.read.parquet(path)
    profile = file_profile({"t": df})
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    got = {str(r.day): (r.n_files, r.n_rows) for r in profile.collect()}
    files = [f.split("day=")[1][:10] for f in df.inputFiles()]
    assert got == {d: (files.count(d), df.where(f"day = '{d}'").count()) for d in set(files)}
    assert all(r.n_bytes > 0 for r in profile.collect())
