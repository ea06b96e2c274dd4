"""The registered query set: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's ``events`` table -- through the AIS fixture
(:mod:`wakeline.sources.fixture`), or directly for ``events_inter_arrival`` --
and runs over all of its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.config import AIS_HEADERS, DEFAULT_CONFIG, FIELDS, NAV_STATUS_REJECT_LOWER
from wakeline.functions.geo import distance_nm
from wakeline.functions.predicates import MMSI_RE, stored_row_counts
from wakeline.functions.text import parse_float, parse_int, parse_timestamp, strip
from wakeline.operators.histogram import gap_histogram, gap_summary
from wakeline.operators.positions import CHECKED, positions_raw, reject_reasons, typed_rows
from wakeline.operators.profile import file_profile, first_vessel, gap_lookup, layout_profile, sample_mmsi, slice_profile, table_profile, vessel_lookup
from wakeline.operators.sequence import ms_between, with_previous_time
from wakeline.operators.vessels import valid_vessels, vessel_counts
from wakeline.plans.incremental import append_and_merge, append_positions, merge_gaps, read_clean
from wakeline.plans.jobs import build_stages, load_report, run_all
from wakeline.session import scratch_path
from wakeline.sources.buckets import counts_in_place, place_by_vessel, semi_join_in_place
from wakeline.sources.csv import read_ais_csv, write_ais_csv
from wakeline.sources.fixture import ais_strings
from wakeline.sources.interleave import write_interleaved
from wakeline.sources.loads import ROW_SCHEMA, append_load, read_rows, with_id_counts
from wakeline.sources.spread import spread
from wakeline.sources.tables import DAY, merge_into_days, write_by_day, write_stage
from wakeline.sources.versions import merge_version, read_version, replace_version
from wakeline.streaming.ingest import start_raw_ingest

CFG = DEFAULT_CONFIG

Query = Callable[[SparkSession, str], DataFrame]


def _stages(spark: SparkSession, sf_dir: str):
    return build_stages(ais_strings(spark, sf_dir), CFG)


def _two_layouts(spark, sf_dir) -> list[str]:
    """The fixture as two CSV folders: the real column order, and the reverse order."""
    rows = ais_strings(spark, sf_dir, in_order=True)
    paths = [scratch_path(spark, "ais-csv"), scratch_path(spark, "ais-csv-reversed")]
    write_ais_csv(rows.where("row_id % 3 <> 0"), paths[0], in_order=True)
    write_ais_csv(rows.where("row_id % 3 = 0"), paths[1], AIS_HEADERS[::-1], in_order=True)
    return paths


def q_csv_scan(spark, sf_dir):
    """CSV files of two column orders read back by header name."""
    return read_ais_csv(spark, _two_layouts(spark, sf_dir)).select(*FIELDS)


def q_pipeline_tables(spark, sf_dir):
    """The whole job from CSV files; report, bins and summary as read from the written tables."""
    paths = run_all(spark, _two_layouts(spark, sf_dir), scratch_path(spark, "ais-tables"), CFG)
    table = lambda name: spark.read.parquet(paths[name])
    report = table("load_report").select(F.lit("load_report").alias("table_name"), F.col("metric").alias("name"), "value")
    bins = table("delta_histogram").select(
        F.lit("delta_histogram").alias("table_name"), F.format_string("bin_%02d", "bin").alias("name"), F.col("n").alias("value"))
    summary = table("delta_summary")
    values = summary.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value"))
                                                 for c in summary.columns))).alias("x"))
    return report.unionByName(bins).unionByName(values.select(F.lit("delta_summary").alias("table_name"), "x.name", "x.value"))


def q_typed_rows(spark, sf_dir):
    return typed_rows(ais_strings(spark, sf_dir))


def q_scalar_battery(spark, sf_dir):
    s = ais_strings(spark, sf_dir)
    mmsi_t = strip(F.col("mmsi"))
    ts = parse_timestamp(F.col("ts"))
    lat, lon, mmsi = parse_float(F.col("lat")), parse_float(F.col("lon")), parse_int(F.col("mmsi"))
    return s.select(
        "row_id",
        strip(F.col("nav_status")).alias("nav_stripped"),
        lat.alias("lat_f"),
        mmsi.alias("mmsi_i"),
        ts.alias("ts_parsed"),
        F.coalesce(mmsi_t.rlike(MMSI_RE), F.lit(False)).alias("mmsi_shape_ok"),
        F.coalesce(mmsi_t == F.repeat(F.substring(mmsi_t, 1, 1), 9), F.lit(False)).alias("mmsi_one_digit"),
        F.lower(strip(F.col("nav_status"))).isin(*NAV_STATUS_REJECT_LOWER).alias("nav_unknown"),
        F.round(distance_nm(lat, lon, CFG.centre_lat, CFG.centre_lon, CFG.earth_radius_nm), 6).alias("dist_nm"),
        F.abs(lat).alias("abs_lat"),
        ms_between(F.lit("2026-04-18 00:00:00").cast("timestamp_ntz"), ts).alias("ms_of_day"),
        F.pmod(mmsi, F.lit(3)).alias("mmsi_mod3"),
    )


def q_distance_nm(spark, sf_dir):
    raw = positions_raw(ais_strings(spark, sf_dir), CFG, ("mmsi", "lat", "lon"))
    return raw.select("row_id", "mmsi", "lat", "lon",
                      F.round(distance_nm("lat", "lon", CFG.centre_lat, CFG.centre_lon, CFG.earth_radius_nm), 6)
                      .alias("distance_nm"))


def q_positions_raw(spark, sf_dir):
    return positions_raw(ais_strings(spark, sf_dir), CFG)


def q_reject_reasons(spark, sf_dir):
    return reject_reasons(ais_strings(spark, sf_dir), CFG)


def q_vessel_counts(spark, sf_dir):
    return vessel_counts(positions_raw(ais_strings(spark, sf_dir), CFG, CHECKED), CFG)


def q_valid_vessels(spark, sf_dir):
    return valid_vessels(positions_raw(ais_strings(spark, sf_dir), CFG, CHECKED), CFG)


def q_positions_clean(spark, sf_dir):
    return _stages(spark, sf_dir).clean


def q_delta_t(spark, sf_dir):
    return _stages(spark, sf_dir).dt


def q_delta_histogram(spark, sf_dir):
    return gap_histogram(_stages(spark, sf_dir).dt, CFG)


def q_delta_summary(spark, sf_dir):
    return gap_summary(_stages(spark, sf_dir).dt, CFG)


def q_load_report(spark, sf_dir):
    return load_report(_stages(spark, sf_dir))


def q_table_profile(spark, sf_dir):
    st = _stages(spark, sf_dir)
    return table_profile({"positions_raw": st.raw, "positions_clean": st.clean, "positions_dt": st.dt})


def q_slice_profile(spark, sf_dir):
    st = _stages(spark, sf_dir)
    return slice_profile({"positions_raw": st.raw, "positions_clean": st.clean}, 3)


def _placed(spark, df, name):
    """``df`` written in the day layout and read back."""
    path = scratch_path(spark, f"{name}-by-day")
    write_by_day(df, path)
    return spark.read.parquet(path)


def q_layout_profile(spark, sf_dir):
    """Rows and vessels per day, counted in tables that the layout writer has written."""
    st = _stages(spark, sf_dir)
    return layout_profile({n: _placed(spark, t, n) for n, t in (("positions_raw", st.raw), ("positions_clean", st.clean))})


def q_sample_mmsi(spark, sf_dir):
    """First 10 vessel ids of the raw and of the clean table (the status report samples both)."""
    st = _stages(spark, sf_dir)
    return (sample_mmsi(st.raw, 10).select(F.lit("positions_raw").alias("table_name"), "mmsi")
            .unionByName(sample_mmsi(st.clean, 10).select(F.lit("positions_clean").alias("table_name"), "mmsi")))


def q_vessel_lookup(spark, sf_dir):
    """One vessel's first reports, looked up in the day layout."""
    return vessel_lookup(_placed(spark, _stages(spark, sf_dir).clean, "positions_clean"), 5)


# the halves of the merge queries overlap in this half hour
MERGE_FROM, MERGE_TO = "2026-04-19 00:00:00", "2026-04-19 00:30:00"


def _merged(spark, sf_dir, when_matched):
    """A table of the rows before ``MERGE_TO`` takes in those from ``MERGE_FROM`` on, whose
    status text is marked so that matched rows show which side won."""
    raw = write_stage(positions_raw(ais_strings(spark, sf_dir), CFG), "positions_raw")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    path = scratch_path(spark, "merge-target")
    write_by_day(raw.filter(F.col("ts") < at(MERGE_TO)), path)
    new = raw.filter(F.col("ts") >= at(MERGE_FROM)).withColumn("nav_status", F.concat(F.col("nav_status"), F.lit(" (new)")))
    return merge_into_days(spark, path, new, "row_id", when_matched).select("row_id", *FIELDS)


def q_merge_keep_existing(spark, sf_dir):
    return _merged(spark, sf_dir, "keep")


def q_merge_replace(spark, sf_dir):
    return _merged(spark, sf_dir, "replace")


def q_events_inter_arrival(spark, sf_dir):
    """The gap operator on another entity time series: events per user (microsecond times)."""
    ev = spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts"))
    with_prev = with_previous_time(ev, key="user_id", ts="ts", order_id="event_id")
    return (with_prev.filter(F.col("prev_ts").isNotNull())
            .select("event_id", "user_id", "ts", "prev_ts", ms_between("prev_ts", "ts").alias("delta_ms")))


def q_stream_ingest(spark, sf_dir):
    """Fixture written as CSV files, loaded by the streaming ingest (several micro-batches)."""
    src = scratch_path(spark, "ais-stream-src")
    write_ais_csv(ais_strings(spark, sf_dir, in_order=True, n_parts=4), src, in_order=True)
    out = scratch_path(spark, "ais-stream-out")
    query = start_raw_ingest(spark, src, out, CFG, checkpoint_location=scratch_path(spark, "ais-stream-ckpt"),
                             max_files_per_trigger=2)
    query.awaitTermination()
    return read_rows(spark, out).select(*FIELDS)


def _three_loads(spark, sf_dir, step) -> str:
    """The fixture in three loads whose reports interleave, so that most of the second and third are late."""
    rows, src, out = ais_strings(spark, sf_dir, in_order=True), scratch_path(spark, "ais-loads-src"), scratch_path(spark, "ais-loads")
    for k in range(3):
        write_ais_csv(rows.where(F.col("row_id") % 3 == k), f"{src}/{k}", AIS_HEADERS if k else AIS_HEADERS[::-1], in_order=True)
        step(out, [f"{src}/{j}" for j in range(k + 1)])  # folders of earlier loads are offered again
    step(out, src + "/*")
    return out


def q_append_loads(spark, sf_dir):
    """Rows of three appended loads, each offered twice; ``n_ids`` tells whether their ids are unique."""
    out = _three_loads(spark, sf_dir, lambda table, paths: append_load(spark, table, paths, CFG))
    return with_id_counts(read_rows(spark, out)).select(*FIELDS, "n_ids")


def q_valid_incremental(spark, sf_dir):
    """The clean table kept load by load: vessels that become valid late bring their older rows."""
    return read_clean(spark, _three_loads(spark, sf_dir, lambda table, paths: append_positions(spark, table, paths, CFG))).select(*FIELDS)


def q_delta_merge(spark, sf_dir):
    """The gap table kept by merges of three loads with late reports."""
    out = _three_loads(spark, sf_dir, lambda path, paths: append_and_merge(spark, path, paths, CFG))
    return merge_gaps(spark, f"{out}/positions", f"{out}/positions_dt", CFG).select("mmsi", "ts", "prev_ts", "delta_t_ms")


def q_file_profile(spark, sf_dir):
    """Rows per day folder of the raw table, from file metadata and footers; every folder has files and bytes."""
    path = scratch_path(spark, "positions_raw-by-day")
    write_by_day(_stages(spark, sf_dir).raw, path)
    profile = file_profile({"positions_raw": spark.read.parquet(path)})
    return profile.select("table_name", DAY, "n_rows", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > 0).alias("has_bytes"))


def q_versioned_merge(spark, sf_dir):
    """The two merges, one after the other, into a versioned table; readers switch from version to version."""
    raw = write_stage(positions_raw(ais_strings(spark, sf_dir), CFG), "positions_raw")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    path = scratch_path(spark, "versioned")
    replace_version(raw.filter(F.col("ts") < at(MERGE_TO)), path)
    marked = lambda m: raw.filter(F.col("ts") >= at(MERGE_FROM)).withColumn("nav_status", F.concat(F.col("nav_status"), F.lit(m)))
    merge_version(spark, path, marked(" (kept out)"), when_matched="keep")
    merge_version(spark, path, marked(" (new)").filter(F.col("ts") < at(MERGE_TO)), keys_keep_day=True)
    return read_version(spark, path, ROW_SCHEMA).select("row_id", *FIELDS)


def q_bucketed_clean(spark, sf_dir):
    """The clean table from raw rows that lie by vessel: neither the counts nor the semi-join shuffles them."""
    raw = write_stage(positions_raw(ais_strings(spark, sf_dir), CFG), "positions_raw")
    name = f"positions_raw_{uuid.uuid4().hex[:12]}"
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = place_by_vessel(raw, name, scratch_path(spark, name), buckets, max(1, raw.count() // buckets))
    valid = counts_in_place(placed, spark, stored_row_counts(CFG)).where(F.col("n_reports") >= CFG.min_reports)
    return semi_join_in_place(placed, spark, valid)


GAP_MS = 900_000


def q_gap_lookup(spark, sf_dir):
    """Gaps of one vessel, of half an hour, and over a quarter of an hour, looked up in one interleaved copy."""
    path = scratch_path(spark, "gaps-interleaved")
    write_interleaved(write_stage(_stages(spark, sf_dir).dt, "positions_dt"), path)
    gaps = spark.read.parquet(path)
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    return gap_lookup(gaps, first_vessel(gaps), at(MERGE_FROM), at(MERGE_TO), GAP_MS)


QUERIES: dict[str, Query] = {
    "ais_csv_scan": q_csv_scan,
    "ais_typed_rows": q_typed_rows,
    "ais_scalar_battery": q_scalar_battery,
    "ais_distance_nm": q_distance_nm,
    "ais_positions_raw": q_positions_raw,
    "ais_reject_reasons": q_reject_reasons,
    "ais_vessel_counts": q_vessel_counts,
    "ais_valid_vessels": q_valid_vessels,
    "ais_positions_clean": q_positions_clean,
    "ais_delta_t": q_delta_t,
    "ais_delta_histogram": q_delta_histogram,
    "ais_delta_summary": q_delta_summary,
    "ais_load_report": q_load_report,
    "ais_table_profile": q_table_profile,
    "ais_slice_profile": q_slice_profile,
    "ais_layout_profile": q_layout_profile,
    "ais_pipeline_tables": q_pipeline_tables,
    "ais_sample_mmsi": q_sample_mmsi,
    "ais_vessel_lookup": q_vessel_lookup,
    "merge_keep_existing": q_merge_keep_existing,
    "merge_replace": q_merge_replace,
    "events_inter_arrival": q_events_inter_arrival,
    "ais_stream_ingest": q_stream_ingest,
    "ais_append_loads": q_append_loads,
    "ais_valid_incremental": q_valid_incremental,
    "ais_delta_merge": q_delta_merge,
    "ais_file_profile": q_file_profile,
    "ais_gap_lookup": q_gap_lookup,
    "ais_bucketed_clean": q_bucketed_clean,
    "ais_versioned_merge": q_versioned_merge,
}
