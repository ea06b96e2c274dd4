"""Replaces and merges that readers never see half done (S3, S6, S7).

A versioned table keeps its rows in ``data/version=<k>/day=<d>`` and, per version, the list of the day folders
that make it up (``days/version=<k>``, a small table). ``CURRENT`` holds one line: the number of the version
to read. A write puts its day folders and its list beside those in use, and switches
``CURRENT`` last, by a rename: before it readers have the old table, after it the new one. A failed write
leaves folders that no list names, and the next write replaces them.

A merge writes the days it touches; the list names the old folders of all other days.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import delete_path, path_exists
from wakeline.sources.tables import DAY, day_of, insert_absent, latest, put_over, write_by_day, write_stage

VERSION = "version"
LIST_SCHEMA = f"{DAY} date, {VERSION} bigint"


def current_version(spark: SparkSession, path: str) -> int | None:
    """The version that readers see; None where the table was never written."""
    pointer = os.path.join(path, "CURRENT")
    return int(spark.read.text(pointer).first()[0]) if path_exists(spark, pointer) else None


def _point_to(spark: SparkSession, path: str, version: int) -> None:
    """Switch ``CURRENT``: written beside it, then renamed over it in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    target, beside = fs.Path(os.path.join(path, "CURRENT")), fs.Path(os.path.join(path, f".CURRENT-{version}"))
    out = target.getFileSystem(conf).create(beside, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf).rename(beside, target, how)


def _folder(path: str, version: int) -> str:
    return os.path.join(path, "data", f"{VERSION}={version}")


def _list(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(LIST_SCHEMA).parquet(os.path.join(path, "days", f"{VERSION}={version}"))


def _name(day) -> str:
    return f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def read_version(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the current one by default: the columns of ``schema`` (DDL) and ``day``.

    The pointer is read once, here: the frame stays on that version whatever is written later, as
    long as its folders are kept (:func:`drop_old_versions`).
    """
    number = current_version(spark, path) if version is None else version
    days = [] if number is None else [(r[VERSION], r[DAY]) for r in _list(spark, path, number).collect()]  # a row per day
    if not days:
        return spark.createDataFrame([], f"{schema}, {DAY} date")
    rows = spark.read.schema(f"{schema}, {VERSION} bigint, {DAY} date").option("basePath", os.path.join(path, "data"))
    return rows.parquet(*(os.path.join(_folder(path, v), _name(d)) for v, d in days)).drop(VERSION)


def _commit(spark: SparkSession, path: str, version: int, days: DataFrame) -> int:
    days.select(F.col(DAY).cast("date"), F.col(VERSION).cast("bigint")).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(path, "days", f"{VERSION}={version}"))
    _point_to(spark, path, version)
    return version


def _days_written(spark: SparkSession, path: str, version: int, schema: str) -> DataFrame:
    rows = spark.read.schema(f"{schema}, {DAY} date").parquet(_folder(path, version))
    return rows.select(DAY).distinct().withColumn(VERSION, F.lit(version).cast("bigint"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != DAY)


def replace_version(df: DataFrame, path: str) -> int:
    """Replace the whole table by ``df``; the new version's number."""
    spark = df.sparkSession
    version = (current_version(spark, path) or 0) + 1
    write_by_day(df, _folder(path, version))
    return _commit(spark, path, version, _days_written(spark, path, version, _ddl(df)))


def merge_version(spark: SparkSession, path: str, new: DataFrame, key: str = "row_id", when_matched: str = "replace",
                  order_by: str | None = None, keys_keep_day: bool = False) -> int:
    """Merge ``new`` (the table's columns) into the table; the new version's number.

    Semantics as in :func:`wakeline.sources.tables.merge_into_days`. The days of the new rows, and unless
    ``keys_keep_day`` promises otherwise those in which their keys stand, are written anew.
    """
    schema, version = _ddl(new), current_version(spark, path)
    if version is None:
        return replace_version(latest(new, key, order_by), path)
    target = read_version(spark, path, schema, version)
    rows = write_stage(latest(new, key, order_by).withColumn(DAY, day_of()), "merge-new")
    hit = rows.select(DAY)
    if not keys_keep_day:
        hit = hit.union(target.select(key, DAY).join(rows.select(key), key, "left_semi").select(DAY))
    hit = write_stage(hit.distinct(), "merge-days")
    touched = target.join(hit, target[DAY].eqNullSafe(hit[DAY]), "left_semi")
    merged = (put_over if when_matched == "replace" else insert_absent)(touched, rows.select(touched.columns), key)
    write_by_day(merged.drop(DAY), _folder(path, version + 1))
    old = _list(spark, path, version)
    kept = old.join(hit, old[DAY].eqNullSafe(hit[DAY]), "left_anti")
    return _commit(spark, path, version + 1, kept.unionByName(_days_written(spark, path, version + 1, schema)))


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the lists and folders that the current version does not use; readers of older ones are void then.

    Returns the number of version folders that were deleted whole.
    """
    number = current_version(spark, path)
    if number is None:
        return 0
    used = {}
    for r in _list(spark, path, number).collect():
        used.setdefault(r[VERSION], set()).add(_name(r[DAY]))
    gone = 0
    for v in range(1, number + 1):
        if v != number:
            delete_path(spark, os.path.join(path, "days", f"{VERSION}={v}"))
        folder = _folder(path, v)
        if not path_exists(spark, folder):
            continue
        if v not in used:
            delete_path(spark, folder)
            gone += 1
        else:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(folder)
            for status in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at):
                if status.getPath().getName().startswith(f"{DAY}=") and status.getPath().getName() not in used[v]:
                    delete_path(spark, status.getPath().toString())
    return gone
