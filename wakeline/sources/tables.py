"""Table IO: replace / append writes (S3, S4), the day layout (S9, S10), and
insert-if-absent and upsert merges on Parquet (S6, S7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import delete_path, scratch_path, scratch_table

DAY = "day"


def write_stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage as Parquet under the shared checkpoint folder and continue from the files.

    One job; it cuts lineage, so a lost executor does not re-run earlier stages, and
    later steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str, order: list[str]) -> DataFrame:
    """A stage written as ``buckets`` buckets of ``key``, each file sorted by ``order``.

    Later grouping by ``key`` needs no shuffle. The table lies under the shared checkpoint folder; its name in
    the session's catalog is its folder's. Beyond the number of buckets that Spark allows, a bucket holds several keys.
    """
    spark = df.sparkSession
    path, table = scratch_table(spark, name)
    allowed = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    df.write.bucketBy(min(buckets, allowed), key).sortBy(*order).option("path", path).saveAsTable(table)
    return spark.table(table)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``overwrite`` replaces the table (drop + load); ``append`` adds rows."""
    df.write.mode(mode).parquet(path)


def day_of(ts: str = "ts") -> Column:
    return F.to_date(ts)


def write_by_day(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lay rows out in day folders, within a file sorted by (mmsi, ts, row_id).

    Rows are dealt by (day, vessel). The rebalance lets Spark size the files by their
    bytes: it joins small parts and splits a large one by its map outputs, so neither
    the core count nor a busy vessel decides a file's size, and no sampling pass reads
    the input twice. Day folders prune time ranges; sorted files give row-group
    min/max skipping for vessel lookups.
    """
    (df.withColumn(DAY, day_of()).hint("rebalance", DAY, "mmsi")
     .sortWithinPartitions(DAY, "mmsi", "ts", "row_id")
     .write.mode(mode).partitionBy(DAY).parquet(path))


def latest(new: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """One row per key: the last by ``order_by`` (ties, and no order: by all columns).

    A partial aggregate, so many rows of one key meet before the shuffle; it holds each row once.
    """
    by = F.struct(*([F.col(order_by).alias("_order_by")] if order_by else []), *new.columns)
    last = new.groupBy(F.col(key).alias("_key")).agg(F.max(by).alias("_row"))
    return last.select(*(F.col("_row").getField(c).alias(c) for c in new.columns))


def insert_absent(target: DataFrame, last: DataFrame, key: str) -> DataFrame:
    """``target`` and the rows of ``last``, one of each key, whose key is absent from it."""
    return target.unionByName(last.join(target.select(key), key, "left_anti").select(*target.columns))


def put_over(target: DataFrame, last: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``last``, one of each key, in the place of those with their keys."""
    return target.join(last.select(key), key, "left_anti").select(*target.columns).unionByName(last.select(*target.columns))


def merge_keep_existing(target: DataFrame, new: DataFrame, key: str = "row_id", order_by: str | None = None) -> DataFrame:
    """Insert rows of ``new`` whose key is absent from ``target``; existing rows stay as they are.

    Of several new rows with one key the last goes in (:func:`latest`).
    """
    return insert_absent(target, latest(new, key, order_by), key)


def merge_replace(target: DataFrame, new: DataFrame, key: str = "row_id", order_by: str | None = None) -> DataFrame:
    """Upsert: a row of ``new`` replaces the whole target row with its key, or is inserted.

    Of several new rows with one key the last counts (:func:`latest`).
    """
    return put_over(target, latest(new, key, order_by), key)


def merge_into_days(spark: SparkSession, path: str, new: DataFrame, key: str = "row_id", when_matched: str = "replace",
                    order_by: str | None = None, keys_keep_day: bool = False) -> DataFrame:
    """Merge ``new`` into the day-layout table at ``path`` and return the table as it is then.

    Only the days that the merge touches are read whole and rewritten: days of the new
    rows, and days in which a key of theirs stands already. They are written beside the
    table first and put in place after that write has ended; days that a replacement
    emptied are removed.

    ``keys_keep_day`` promises that a key's rows never change their day (a report's time is
    fixed): then only the days of the new rows can hold their keys, and the other days are not
    searched. Such a merge removes no folder and may be repeated after a failure.
    """
    target = spark.read.parquet(path)
    rows = write_stage(latest(new, key, order_by).withColumn(DAY, day_of()), "merge-new")
    hit = rows.select(DAY)
    if not keys_keep_day:
        hit = hit.union(write_stage(target.select(key, DAY).join(rows.select(key), key, "left_semi"), "merge-matched").select(DAY))
    days = [r[DAY] for r in hit.distinct().collect()]  # touched days
    if not days:
        return target
    # a key may stand in another day than its new row: both sides are in the touched days
    touched = target.where(F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() & F.lit(None in days)))
    merged = (put_over if when_matched == "replace" else insert_absent)(touched, rows, key)
    staged = write_stage(merged.hint("rebalance", DAY, "mmsi").sortWithinPartitions(DAY, "mmsi", "ts", key), "merge-staged")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))
    left = {r[DAY] for r in staged.select(DAY).distinct().collect()}
    for day in days:
        if day not in left:
            delete_path(spark, f"{path}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")
    return spark.read.parquet(path)
