"""Parallelism for inputs that arrive as fewer splits than the cluster has cores."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the session's cores when it yields fewer partitions.

    A single-row-group Parquet file is one task however CPU-heavy the per-row
    parsing that follows; on real inputs (many splits) this is a no-op, so no
    shuffle is added at scale. The check is planning-only (no job runs), and rows are
    the same either way.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except PySparkException:  # a session without the RDD API keeps the scan as it is
        return df
    return df.repartition(target) if current < target else df


def width(df: DataFrame) -> int:
    """The number of partitions of a scan, which grows with its input (planning only); the shuffle's where the session has no RDD API."""
    try:
        return max(1, df.rdd.getNumPartitions())
    except PySparkException:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
