"""Composite jobs: the whole pipeline (C1-C5) with persisted stage tables."""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, AisConfig
from wakeline.operators.histogram import gap_histogram, gap_summary
from wakeline.operators.positions import positions_raw
from wakeline.operators.profile import metric_rows
from wakeline.operators.sequence import positions_dt
from wakeline.operators.vessels import positions_clean
from wakeline.sources.csv import observed, read_ais_csv
from wakeline.sources.tables import write_by_day, write_stage, write_table


@dataclass
class Stages:
    """The stored tables of a load and what was counted while it ran."""

    raw: DataFrame
    clean: DataFrame
    dt: DataFrame
    read: dict[str, int]


def build_stages(strings: DataFrame, cfg: AisConfig = DEFAULT_CONFIG) -> Stages:
    """raw -> clean -> dt. Raw and clean are written once each; all later steps read them.

    ``dt`` is a plan over the stored clean table.
    """
    counted, seen = observed(strings)
    raw = write_stage(positions_raw(counted, cfg), "positions_raw")
    clean = write_stage(positions_clean(raw, cfg), "positions_clean")
    return Stages(raw, clean, positions_dt(clean, cfg), dict(seen.get))


def load_report(stages: Stages) -> DataFrame:
    """Counts of a load as (metric, value), by metric.

    Rows read and malformed were counted in the load; the rest are counts of stored
    tables. Every valid vessel has rows in the clean table, so its vessels are the valid ones.
    """
    spark = stages.raw.sparkSession
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    read = {k: spark.range(1).select(F.lit(v).alias("n")) for k, v in stages.read.items()}
    return metric_rows({
        **read,
        "rows_inserted_raw": count(stages.raw),
        "valid_vessels": stages.clean.agg(F.count_distinct("mmsi").alias("n")),
        "rows_clean": count(stages.clean),
        "rows_delta": count(stages.dt),
    }).orderBy("metric")


TABLES = ("positions_raw", "positions_clean", "positions_dt", "delta_histogram", "delta_summary", "load_report")


def run_all(spark: SparkSession, csv_paths: str | list[str], out_dir: str, cfg: AisConfig = DEFAULT_CONFIG,
            multiline: bool = False, timings: dict[str, float] | None = None) -> dict[str, str]:
    """Load CSV -> raw -> clean -> dt -> histogram, each written as a table under ``out_dir``.

    One scan of the input. Every stage reads the table of the one before, so a lost
    executor only recomputes the current stage. The position tables lie by day
    (:func:`write_by_day`). ``timings``, when given, receives the wall seconds of each phase.
    """
    clock = {"t": time.perf_counter()}

    def phase(name: str) -> None:
        now = time.perf_counter()
        if timings is not None:
            timings[name] = round(now - clock["t"], 3)
        clock["t"] = now

    paths = {name: os.path.join(out_dir, name) for name in TABLES}

    def placed(df: DataFrame, name: str) -> DataFrame:
        write_by_day(df, paths[name])
        return spark.read.parquet(paths[name]).select(*df.columns)

    counted, seen = observed(read_ais_csv(spark, csv_paths, multiline))
    raw = placed(write_stage(positions_raw(counted, cfg), "positions_raw"), "positions_raw")
    phase("load_raw")
    clean = placed(positions_clean(raw, cfg), "positions_clean")
    phase("clean")
    dt = placed(positions_dt(clean, cfg), "positions_dt")
    phase("delta")
    write_table(gap_histogram(dt, cfg), paths["delta_histogram"])
    write_table(gap_summary(dt, cfg), paths["delta_summary"])
    phase("histogram")
    write_table(load_report(Stages(raw, clean, dt, dict(seen.get))), paths["load_report"])
    phase("report")
    return paths
