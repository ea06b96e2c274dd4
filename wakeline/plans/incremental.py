"""The pipeline kept up to date load by load: raw, valid vessels, clean and gaps (S4, A1/A2, C2, C3 by merges).

Each load adds its part to four tables under one folder, all of them written before the load is recorded
(:mod:`wakeline.sources.loads`), so a failed load is not seen and may be tried again:

* ``rows`` -- the load's raw rows, by day;
* ``counts`` -- counted reports per vessel of the load; sums over loads are the valid set;
* ``clean`` -- the load's rows of valid vessels, and of vessels that have become valid with this load their rows of earlier loads;
* ``vessel_days`` -- first and last report per vessel and day of what the load added to clean.

The gap table is kept by a merge that touches only the neighbourhood of what a load added to clean, late reports
included: the vessel days that received rows, and the next report after each (:func:`merge_gaps`).
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, FIELDS, AisConfig
from wakeline.operators.joins import semi_join_stored
from wakeline.operators.sequence import positions_dt
from wakeline.operators.vessels import vessel_counts
from wakeline.session import path_exists
from wakeline.sources.loads import (
    LOAD, ROW_SCHEMA, add_load, load_numbers, part_path, read_parts,
)
from wakeline.sources.tables import DAY, day_of, merge_into_days, write_by_day, write_stage

COUNTS = "mmsi bigint, n_reports bigint"
VESSEL_DAYS = "mmsi bigint, at date, first struct<ts:timestamp_ntz,row_id:bigint>, last struct<ts:timestamp_ntz,row_id:bigint>"
FEW_VESSELS = 1_000  # named in the filter, so that row groups of other vessels are skipped


def vessel_days(clean: DataFrame) -> DataFrame:
    """First and last report ``(ts, row_id)`` of each vessel and day."""
    report = F.struct("ts", "row_id")
    return (clean.where(F.col("mmsi").isNotNull() & F.col("ts").isNotNull()).groupBy("mmsi", day_of().alias("at"))
            .agg(F.min(report).alias("first"), F.max(report).alias("last")))


def _total(counts: DataFrame, out: str) -> DataFrame:
    return counts.groupBy("mmsi").agg(F.sum("n_reports").alias(out))


def _turned_valid(spark: SparkSession, table: str, number: int, earlier: list[int], cfg: AisConfig) -> tuple[DataFrame, DataFrame]:
    """Valid vessels with load ``number``, and those of them that were seen before but not valid (both stored)."""
    before = _total(read_parts(spark, table, "counts", COUNTS, earlier), "before")
    now = _total(read_parts(spark, table, "counts", COUNTS, [*earlier, number]), "now")
    valid = write_stage(now.join(before, "mmsi", "left").where(F.col("now") >= cfg.min_reports), "valid")
    return valid.select("mmsi"), valid.where(F.col("before") < cfg.min_reports).select("mmsi")


def _older_rows(spark: SparkSession, table: str, vessels: DataFrame, earlier: list[int]) -> DataFrame:
    """Rows of ``vessels`` in earlier loads; only loads that have some, and where the vessels are few, their row groups."""
    counted = read_parts(spark, table, "counts", COUNTS, earlier)
    numbers = sorted(r[LOAD] for r in counted.join(vessels, "mmsi", "left_semi").select(LOAD).distinct().collect())
    rows = read_parts(spark, table, "rows", ROW_SCHEMA, numbers)
    few = [r.mmsi for r in vessels.limit(FEW_VESSELS + 1).collect()]
    if len(few) <= FEW_VESSELS:
        rows = rows.where(F.col("mmsi").isin(few))
    return semi_join_stored(rows, vessels, "mmsi")


def append_positions(spark: SparkSession, table: str, paths: str | list[str], cfg: AisConfig = DEFAULT_CONFIG,
                     multiline: bool = False) -> int | None:
    """Append the files under ``paths`` that are new: raw rows, counts, clean rows and vessel days of one load.

    Returns the load's number, None where no file is new.
    """
    def derived(number: int) -> None:
        earlier = load_numbers(spark, table)
        raw = read_parts(spark, table, "rows", ROW_SCHEMA, [number])
        vessel_counts(raw, cfg).write.mode("overwrite").parquet(part_path(table, "counts", number))
        valid, turned = _turned_valid(spark, table, number, earlier, cfg)
        columns = ["row_id", *FIELDS]
        added = raw.join(valid, "mmsi", "left_semi").select(columns)
        if not turned.isEmpty():
            added = added.unionByName(_older_rows(spark, table, turned, earlier).select(columns))
        write_by_day(added, part_path(table, "clean", number))
        days = vessel_days(read_parts(spark, table, "clean", ROW_SCHEMA, [number]))
        days.write.mode("overwrite").parquet(part_path(table, "vessel_days", number))

    return add_load(spark, table, paths, cfg, multiline, derived)


def read_clean(spark: SparkSession, table: str, numbers: list[int] | None = None) -> DataFrame:
    """Clean rows as of the recorded loads: ``row_id``, the fields, ``load`` and ``day``."""
    return read_parts(spark, table, "clean", ROW_SCHEMA, load_numbers(spark, table) if numbers is None else numbers)


def changed_gaps(spark: SparkSession, table: str, number: int, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    """Gap rows, as of load ``number``, of the vessel days that it added rows to and of the next report after each.

    What stands before a vessel day is known from the stored vessel days: that one report takes part as a
    marker. The next report after it, in a later day, is the only row there whose previous time can change.
    """
    numbers = [n for n in load_numbers(spark, table) if n <= number]
    touched = write_stage(read_parts(spark, table, "vessel_days", VESSEL_DAYS, [number]).select("mmsi", "at").distinct(), "touched")
    of_vessel = Window.partitionBy("mmsi").orderBy("at")  # a row per day of a vessel
    known = semi_join_stored(read_parts(spark, table, "vessel_days", VESSEL_DAYS, numbers), touched.select("mmsi").distinct(), "mmsi")
    days = (known.groupBy("mmsi", "at").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .join(touched.withColumn("touched", F.lit(True)), ["mmsi", "at"], "left")
            .withColumn("before", F.lag(F.struct("last", "touched")).over(of_vessel))
            .withColumn("after", F.lead(F.struct("at", "first", "touched")).over(of_vessel)))
    near = write_stage(days.where("touched"), "near-days")
    markers = near.where("before.last IS NOT NULL AND before.touched IS NULL").select("mmsi", "before.last.*")
    later = near.where("after.at IS NOT NULL AND after.touched IS NULL").select("mmsi", "after.at", "after.first.row_id")

    clean = read_clean(spark, table, numbers).withColumnRenamed(DAY, "at")
    of_days = lambda df: clean.where(F.col("at").isin([r.at for r in df.select("at").distinct().collect()]))
    inside = of_days(touched).join(touched, ["mmsi", "at"], "left_semi")
    following = of_days(later).join(later, ["mmsi", "at", "row_id"], "left_semi")
    columns = ["row_id", *FIELDS]
    parts = [df.select(columns).withColumn("marker", F.lit(False)) for df in (inside, following)]
    parts.append(markers.withColumn("marker", F.lit(True)))
    rows = write_stage(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "neighbours")
    return positions_dt(rows, cfg).where("NOT marker").drop("marker")


def merge_gaps(spark: SparkSession, table: str, gaps: str, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    """Bring the gap table at ``gaps`` (by day) up to the recorded loads, load by load, and return it.

    Days that hold neither a touched vessel day nor a next report keep their files. A merge that failed is
    done again: a report's day never changes, so repeating a merge gives the same rows.
    """
    done_path = gaps.rstrip("/") + "_loads"
    done = {r[LOAD] for r in spark.read.parquet(done_path).collect()} if path_exists(spark, done_path) else set()
    for number in load_numbers(spark, table):
        if number in done:
            continue
        changed = changed_gaps(spark, table, number, cfg)
        if done and not _gaps_at(spark, gaps).isEmpty():
            merge_into_days(spark, gaps, changed, "row_id", keys_keep_day=True)
        else:
            write_by_day(changed, gaps)
        done.add(number)
        spark.range(number, number + 1).select(F.col("id").alias(LOAD)).coalesce(1).write.mode("append").parquet(done_path)
    return _gaps_at(spark, gaps)


def _gaps_at(spark: SparkSession, gaps: str) -> DataFrame:
    return spark.read.schema(f"{ROW_SCHEMA}, prev_ts timestamp_ntz, delta_t_ms bigint, {DAY} date").parquet(gaps)


def append_and_merge(spark: SparkSession, out_dir: str, paths: str | list[str], cfg: AisConfig = DEFAULT_CONFIG,
                     multiline: bool = False) -> DataFrame:
    """One load into the tables under ``out_dir`` and the gap table brought up to date, which is returned."""
    table = os.path.join(out_dir, "positions")
    append_positions(spark, table, paths, cfg, multiline)
    return merge_gaps(spark, table, os.path.join(out_dir, "positions_dt"), cfg)
