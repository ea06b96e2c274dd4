"""Expected counts of the events-derived fixture (FIXTURES F4) and pipeline invariants."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, SF01
from wakeline.config import AIS_HEADERS, AisConfig
from wakeline.operators.histogram import gap_histogram, gap_summary
from wakeline.operators.vessels import valid_vessels
from wakeline.plans.jobs import build_stages, run_all
from wakeline.session import scratch_path
from wakeline.sources.csv import write_ais_csv
from wakeline.sources.fixture import ais_strings

EXPECTED = {
    # raw, raw vessels, valid vessels, clean, dt rows, delta == 0, delta > 1e6, NaN rot in raw
    SF001: (779, 10, 4, 431, 427, 60, 0, 8),
    SF01: (7900, 100, 31, 3457, 3426, 62, 808, 78),
}


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_fixture_counts(spark, sf_dir):
    st = build_stages(ais_strings(spark, sf_dir))
    d = F.col("delta_t_ms")
    dt = st.dt.agg(F.count(F.lit(1)), F.count_if(d == 0), F.count_if(d > 1_000_000)).collect()[0]
    got = (st.raw.count(), st.raw.select("mmsi").distinct().count(), valid_vessels(st.raw).count(),
           st.clean.count(), dt[0], dt[1], dt[2], st.raw.filter(F.isnan("rot")).count())
    assert got == EXPECTED[sf_dir]


def test_invariants(spark):
    st = build_stages(ais_strings(spark, SF01))
    clean_vessels = st.clean.select("mmsi").distinct().count()
    assert st.dt.count() == st.clean.count() - clean_vessels
    assert st.dt.filter(F.col("delta_t_ms") < 0).count() == 0
    per_vessel = st.dt.groupBy("mmsi").agg(F.sum("delta_t_ms").alias("s")).collect()
    span = {r.mmsi: r.s for r in st.clean.groupBy("mmsi").agg(
        ((F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))) * 1000).alias("s")).collect()}
    assert all(span[r.mmsi] == r.s for r in per_vessel)
    hist = gap_histogram(st.dt).agg(F.sum("n")).collect()[0][0]
    assert hist == gap_summary(st.dt).collect()[0].n_in_range


def test_partition_count_does_not_change_results(spark):
    results = []
    for n in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        st = build_stages(ais_strings(spark, SF001))
        results.append(sorted(tuple(r) for r in st.dt.select("row_id", "mmsi", "ts", "prev_ts", "delta_t_ms").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_threshold_is_a_parameter(spark):
    st = build_stages(ais_strings(spark, SF001), AisConfig(min_reports=1))
    assert valid_vessels(st.raw, AisConfig(min_reports=1)).count() == 10


def test_run_all_from_csv(spark):
    rows = ais_strings(spark, SF001)
    src = [scratch_path(spark, "run-all-csv"), scratch_path(spark, "run-all-csv-2")]
    write_ais_csv(rows.where("row_id < 500"), src[0])
    write_ais_csv(rows.where("row_id >= 500"), src[1], AIS_HEADERS[::-1])
    paths = run_all(spark, src, scratch_path(spark, "run-all-out"))
    assert spark.read.parquet(paths["positions_raw"]).count() == 779
    assert spark.read.parquet(paths["positions_clean"]).count() == 431
    assert spark.read.parquet(paths["positions_dt"]).count() == 427
    assert spark.read.parquet(paths["delta_histogram"]).count() == 50
    report = [(r.metric, r.value) for r in spark.read.parquet(paths["load_report"]).collect()]
    assert dict(report) == {"rows_read": 1000, "rows_malformed": 0, "rows_inserted_raw": 779, "valid_vessels": 4,
                            "rows_clean": 431, "rows_delta": 427}


def test_profiles_are_sorted(spark):
    from wakeline.operators.profile import slice_profile, table_profile
    from wakeline.plans.jobs import load_report

    st = build_stages(ais_strings(spark, SF001))
    tables = {"positions_raw": st.raw, "positions_clean": st.clean}
    names = [r.table_name for r in table_profile(tables).collect()]
    slices = [(r.table_name, r.slice) for r in slice_profile(tables, 3).collect()]
    metrics = [r.metric for r in load_report(st).collect()]
    assert names == sorted(names) and slices == sorted(slices) and metrics == sorted(metrics)


def test_empty_clean_table_flows_through(spark):
    from wakeline.operators.profile import vessel_lookup

    cfg = AisConfig(min_reports=10**9)  # no vessel qualifies
    st = build_stages(ais_strings(spark, SF001), cfg)
    assert st.clean.count() == 0 and st.dt.count() == 0
    hist = gap_histogram(st.dt, cfg).collect()
    assert len(hist) == 50 and sum(r.n for r in hist) == 0
    assert gap_summary(st.dt, cfg).collect()[0].n_plotted == 0
    assert vessel_lookup(st.clean).count() == 0
