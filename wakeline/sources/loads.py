"""Appending loads to one table (S4, S8): row ids unique over all loads, appends that can be repeated.

A load table is a folder: ``rows/load=<n>/day=<d>`` holds the rows of load n in the day
layout, ``loads`` one row per file that was loaded. A load is written to its own folder first and
recorded last, and readers look at recorded loads only: a load that failed half way is not
seen, and is overwritten when it is tried again. Files that a recorded load has taken
are left out of later ones, so a repeated append adds nothing.

Row ids hold the number of the split they were read in, counted on over all loads: the record of a
load tells the first number that is free after it. There are 2**30 numbers, at 128 MB a split enough for 130 PB.

One writer at a time: two loads started together would take the same number.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, FIELD_KINDS, FIELDS, AisConfig
from wakeline.operators.positions import positions_raw
from wakeline.session import path_exists
from wakeline.sources.csv import SPLIT_BITS, input_files, literal_path, observed, read_ais_csv
from wakeline.sources.tables import write_by_day, write_stage

LOAD = "load"
_SQL_TYPES = {"ts": "timestamp_ntz", "int": "bigint", "float": "double", "text": "string"}
ROW_SCHEMA = "row_id bigint, " + ", ".join(f"{f} {_SQL_TYPES[FIELD_KINDS[f]]}" for f in FIELDS)
RECORD_SCHEMA = ("load bigint, file string, bytes bigint, modified timestamp, next_split bigint, "
                 "rows_read bigint, rows_malformed bigint, rows_kept bigint")


def loads(spark: SparkSession, table: str) -> DataFrame:
    """The record of a load table: one row per file, with the load's number and counts."""
    path = os.path.join(table, "loads")
    return (spark.read.schema(RECORD_SCHEMA).parquet(path) if path_exists(spark, path)
            else spark.createDataFrame([], RECORD_SCHEMA))


def load_numbers(spark: SparkSession, table: str) -> list[int]:
    """The numbers of the recorded loads, ascending."""
    return sorted(r.load for r in loads(spark, table).select(LOAD).distinct().collect())


def part_path(table: str, part: str, load: int) -> str:
    return os.path.join(table, part, f"{LOAD}={load}")


def read_parts(spark: SparkSession, table: str, part: str, schema: str, numbers: list[int]) -> DataFrame:
    """The rows that the given loads have written to one part of the table, with ``load``, and ``day`` where they lie by day.

    Folders are named one by one, so what other loads have left there is not even listed.
    """
    paths = [p for p in (part_path(table, part, n) for n in numbers) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema).withColumn(LOAD, F.lit(None).cast("bigint")).withColumn("day", F.lit(None).cast("date"))
    rows = spark.read.schema(f"{schema}, {LOAD} bigint, day date").option("basePath", os.path.join(table, part))
    return rows.parquet(*paths)


def read_rows(spark: SparkSession, table: str, numbers: list[int] | None = None) -> DataFrame:
    """Rows of the recorded loads (or of some of them): ``row_id``, the fields, ``load`` and ``day``."""
    return read_parts(spark, table, "rows", ROW_SCHEMA, load_numbers(spark, table) if numbers is None else numbers)


def with_id_counts(rows: DataFrame) -> DataFrame:
    """``rows``, a stored table, with ``n_ids``: how many of them have the row's ``row_id``.

    Only ids that occur more than once are stored and joined: where there are few or none, the rows stay where they lie.
    """
    counts = rows.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_ids"))
    repeated = write_stage(counts.where(F.col("n_ids") > 1), "repeated-ids")
    return rows.join(repeated, "row_id", "left").withColumn("n_ids", F.coalesce("n_ids", F.lit(1).cast("bigint")))


def add_load(spark: SparkSession, table: str, paths: str | list[str], cfg: AisConfig = DEFAULT_CONFIG,
             multiline: bool = False, derived: Callable[[int], None] | None = None) -> int | None:
    """Load the files under ``paths`` that no load has taken yet; the load's number, None where there is none.

    A file is known by its path, size and time of change; one that was changed is loaded again.
    ``derived`` is called with the load's number when its rows are written and before it is recorded, to write
    further parts of it.
    """
    known = loads(spark, table)
    listed = input_files(spark, paths).distinct()
    new = write_stage(listed.join(known.select("file", "bytes", "modified"), ["file", "bytes", "modified"], "left_anti"), "new-files")
    files = sorted(r.file for r in new.select("file").collect())  # names, which the scan needs
    if not files:
        return None
    last = known.agg(F.max(LOAD), F.max("next_split")).first()
    number, first_split = (0 if last[0] is None else last[0] + 1), last[1] or 0
    strings, seen = observed(read_ais_csv(spark, [literal_path(f) for f in files], multiline, first_split))
    # stored before they are placed: the scan runs once, and its counts are those of that one run
    write_by_day(write_stage(positions_raw(strings, cfg), "load-rows"), part_path(table, "rows", number))
    written = read_parts(spark, table, "rows", ROW_SCHEMA, [number]).agg(F.max("row_id"), F.count(F.lit(1))).first()
    if derived:
        derived(number)
    record = {"next_split": first_split if written[0] is None else (written[0] >> SPLIT_BITS) + 1,
              "rows_read": seen.get["rows_read"], "rows_malformed": seen.get["rows_malformed"], "rows_kept": written[1]}
    (new.select(F.lit(number).cast("bigint").alias(LOAD), "file", "bytes", "modified",
                *(F.lit(n).cast("bigint").alias(c) for c, n in record.items()))
     .coalesce(1).write.mode("append").parquet(os.path.join(table, "loads")))
    return number


def append_load(spark: SparkSession, table: str, paths: str | list[str], cfg: AisConfig = DEFAULT_CONFIG,
                multiline: bool = False) -> int | None:
    """:func:`add_load` of the raw rows alone."""
    return add_load(spark, table, paths, cfg, multiline)
