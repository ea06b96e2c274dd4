"""Loads into one table: unique ids, repeated appends, and tables kept up to date equal a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from wakeline.config import AisConfig
from wakeline.operators.sequence import positions_dt
from wakeline.operators.vessels import positions_clean
from wakeline.plans.incremental import append_and_merge, append_positions, merge_gaps, read_clean
from wakeline.session import path_exists, scratch_path
from wakeline.sources import loads
from wakeline.sources.loads import append_load, part_path, read_rows
from wakeline.sources.tables import merge_into_days, write_by_day, write_stage

HEADER = "# Timestamp,MMSI,Latitude,Longitude,Navigational status,ROT,SOG,COG,Heading"
CFG = AisConfig(min_reports=3)


def land(folder, name, reports):
    """A CSV file of (vessel, day, seconds) reports."""
    lines = [f"{d:02d}/04/2026 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d},{219000000 + v},55.5,12.0,Under way,0,10.2,90,90" for v, d, s in reports]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def gaps(df):
    return sorted(((r.mmsi, str(r.ts), str(r.prev_ts), r.delta_t_ms) for r in df.select("mmsi", "ts", "prev_ts", "delta_t_ms").collect()))


def ids(df):
    return sorted(r.row_id for r in df.select("row_id").collect())


def test_ids_are_unique_over_loads_and_a_repeat_adds_nothing(spark, tmp_path):
    table, src = scratch_path(spark, "loads"), tmp_path / "in"
    land(src, "a.csv", [(1, 18, 10 * i) for i in range(3)])
    assert append_load(spark, table, str(src)) == 0
    assert append_load(spark, table, str(src)) is None
    land(src, "b [1].csv", [(1, 18, 30 + 10 * i) for i in range(3)])
    land(src, "c.csv", [(2, 19, 0)])
    assert append_load(spark, table, str(src)) == 1
    assert append_load(spark, table, str(src)) is None
    rows = read_rows(spark, table)
    assert rows.count() == 7 and len(set(ids(rows))) == 7
    assert sorted((r.load, r.file.rsplit("/")[-1], r.rows_kept) for r in loads.loads(spark, table).collect()) == [
        (0, "a.csv", 3), (1, "b [1].csv", 4), (1, "c.csv", 4)]
    got = positions_dt(write_stage(rows, "rows"))
    assert [g[3] for g in gaps(got)] == [10_000] * 5


def test_merges_of_a_second_load_touch_no_other_rows(spark, tmp_path):
    table, path = scratch_path(spark, "loads-merge"), scratch_path(spark, "merged")
    land(tmp_path / "x", "a.csv", [(1, 18, i) for i in range(3)])
    land(tmp_path / "y", "b.csv", [(2, 18, i) for i in range(3)])
    append_load(spark, table, str(tmp_path / "x"))
    append_load(spark, table, str(tmp_path / "y"))
    first, second = (read_rows(spark, table, [n]).drop("load", "day") for n in (0, 1))
    write_by_day(first, path)
    for how in ("replace", "keep", "replace"):
        assert merge_into_days(spark, path, second, when_matched=how).count() == 6


def test_a_load_that_failed_is_not_seen_and_is_done_again(spark, tmp_path, monkeypatch):
    table, src = scratch_path(spark, "loads-fail"), tmp_path / "in"
    land(src, "a.csv", [(1, 18, i) for i in range(4)])
    append_positions(spark, table, str(src), CFG)
    land(src, "b.csv", [(2, 18, i) for i in range(4)])

    def lost(*_):
        raise RuntimeError("driver lost")

    from wakeline.plans import incremental

    with monkeypatch.context() as m:
        m.setattr(incremental, "vessel_days", lost)
        with pytest.raises(RuntimeError):
            append_positions(spark, table, str(src), CFG)
    assert path_exists(spark, part_path(table, "rows", 1))  # written, not recorded
    assert read_rows(spark, table).count() == 4 and read_clean(spark, table).count() == 4
    land(src, "c.csv", [(2, 18, 9)])  # the next attempt finds one more file
    assert append_positions(spark, table, str(src), CFG) == 1
    assert read_rows(spark, table).count() == 9 and len(set(ids(read_rows(spark, table)))) == 9


def test_only_rejected_rows_and_empty_files(spark, tmp_path):
    table, src = scratch_path(spark, "loads-none"), tmp_path / "in"
    src.mkdir()
    (src / "empty.csv").write_text("")
    (src / "bad.csv").write_text(HEADER + "\nnot a time,1,2,3\n")
    assert append_positions(spark, table, str(src), CFG) == 0
    assert read_rows(spark, table).count() == 0 and read_clean(spark, table).count() == 0
    assert merge_gaps(spark, table, scratch_path(spark, "gaps-none"), CFG).count() == 0
    land(src, "good.csv", [(1, 18, i) for i in range(3)])
    assert append_positions(spark, table, str(src), CFG) == 1
    assert read_clean(spark, table).count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_random_loads_equal_a_full_rebuild(spark, tmp_path, seed):
    """Late reports, ties, vessels that become valid later: clean and gaps as if all files had come at once."""
    rng = random.Random(seed)
    out, src = scratch_path(spark, "incremental"), tmp_path / "in"
    for load in range(3):
        reports = [(rng.randrange(6), 17 + rng.randrange(5), rng.choice([0, 5, 5, 60, 86_399, rng.randrange(86_400)]))
                   for _ in range(rng.choice([4, 15]))]
        land(src, f"{load}.csv", reports)
        merged = append_and_merge(spark, out, str(src), CFG)
        raw = write_stage(read_rows(spark, f"{out}/positions").drop("load", "day"), "raw")
        clean = write_stage(positions_clean(raw, CFG), "clean")
        assert ids(read_clean(spark, f"{out}/positions")) == ids(clean)
        want = positions_dt(clean, CFG)
        assert gaps(merged) == gaps(want)
        assert ids(merged) == ids(want)


def test_untouched_days_keep_their_files(spark, tmp_path):
    out, src = scratch_path(spark, "incremental-days"), tmp_path / "in"
    land(src, "a.csv", [(v, d, s) for v in (1, 2) for d in (17, 18, 19, 20, 21) for s in (0, 10)])
    files = lambda df: {f for f in df.inputFiles()}
    before = files(append_and_merge(spark, out, str(src), CFG))
    land(src, "late.csv", [(1, 18, 5), (1, 18, 40_000)])
    after = append_and_merge(spark, out, str(src), CFG)
    kept = {f.split("day=")[1][:10] for f in before & files(after)}
    assert kept == {"2026-04-17", "2026-04-20", "2026-04-21"}  # 18 received rows, 19 holds the next report
    day = {(r.mmsi, str(r.ts)): r.delta_t_ms for r in after.where("mmsi = 219000001").collect()}
    assert day[219000001, "2026-04-18 00:00:05"] == 5000 and day[219000001, "2026-04-18 00:00:10"] == 5000
    assert day[219000001, "2026-04-19 00:00:00"] == (86_400 - 40_000) * 1000
    assert after.count() == 20


def test_repeating_a_merge_changes_nothing(spark, tmp_path):
    out, src = scratch_path(spark, "incremental-again"), tmp_path / "in"
    land(src, "a.csv", [(1, 18, s) for s in range(5)])
    append_and_merge(spark, out, str(src), CFG)
    land(src, "b.csv", [(1, 18, 100 + s) for s in range(5)])
    want = gaps(append_and_merge(spark, out, str(src), CFG))
    from wakeline.plans.incremental import changed_gaps

    table, path = f"{out}/positions", f"{out}/positions_dt"
    again = merge_into_days(spark, path, changed_gaps(spark, table, 1, CFG), keys_keep_day=True)
    assert gaps(again) == want
    assert gaps(merge_gaps(spark, table, path, CFG)) == want


def test_counts_of_ids_leave_the_rows_where_they_lie(spark):
    """The join with the counts of all ids shuffled every field."""
    from wakeline.sources.loads import with_id_counts

    once = write_stage(spark.range(2_000).select(F.col("id").alias("row_id"), F.lit("x").alias("name")), "once")
    counted = with_id_counts(once)
    assert {r.n_ids for r in counted.collect()} == {1} and counted.count() == 2_000
    assert "SortMergeJoin" not in counted._jdf.queryExecution().executedPlan().toString()
    twice = write_stage(once.unionByName(once.where("row_id % 7 = 0")).unionByName(once.where("row_id = 7")), "twice")
    want = {i: 3 if i == 7 else 2 if i % 7 == 0 else 1 for i in range(2_000)}
    got = sorted((r.row_id, r.n_ids) for r in with_id_counts(twice).collect())
    assert got == sorted((i, n) for i, n in want.items() for _ in range(n))


def test_the_files_of_a_load_are_ordered_before_their_fields_are_made(spark, tmp_path):
    """Ranges were cut and shuffled with all 26 fields, which were made once more for the sample."""
    from wakeline.config import FIELDS
    from wakeline.sources.csv import write_ais_csv
    from wakeline.sources.fixture import ais_strings

    sf = tmp_path / "sf"
    (spark.range(300).orderBy(F.rand(1)).select(F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), F.lit("e").alias("event_type"))
     .write.parquet(str(sf / "events.parquet")))
    rows = ais_strings(spark, str(sf), in_order=True, n_parts=3).where("row_id % 3 = 1")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    ranged = plan[plan.index("RepartitionByExpression"):]
    assert "Filter" in ranged and not any(f" AS {f}#" in ranged for f in FIELDS)
    write_ais_csv(rows, str(tmp_path / "csv"), in_order=True)
    lines = [x.splitlines()[1:] for x in (f.read_text() for f in sorted((tmp_path / "csv").glob("part-*.csv"))) if x]
    assert len(lines) == 3
    want = ais_strings(spark, str(sf)).where("row_id % 3 = 1").orderBy("row_id").select("ts", "mobile_type").collect()
    assert [x.split(",")[:2] for part in lines for x in part] == [[r.ts, r.mobile_type] for r in want]
