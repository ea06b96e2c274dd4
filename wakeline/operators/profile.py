"""Status profiles: table counts (A3, A4), load report (A5), placement profiles (A7),
ordered samples and point lookups (O2-O4, P19, P20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.sources.tables import DAY


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows and distinct vessels (one aggregate per table, unioned), by table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("mmsi").alias("n_vessels"))
             .select(F.lit(name).alias("table_name"), "n_rows", "n_vessels")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def metric_rows(metrics: dict[str, DataFrame]) -> DataFrame:
    """(metric, value) rows from one-column, one-row count frames, unioned (no cross join)."""
    parts = [df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).cast("bigint").alias("value"))
             for name, df in metrics.items()]
    return reduce(DataFrame.unionByName, parts)


def slice_profile(tables: dict[str, DataFrame], n_slices: int = 3) -> DataFrame:
    """Rows per ``mmsi mod n`` slice, per table (the original splits work this way)."""
    parts = [df.groupBy(F.pmod("mmsi", F.lit(n_slices)).cast("int").alias("slice"))
             .agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "slice", "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name", "slice")


def layout_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and vessels per table and day folder, of tables in the day layout."""
    parts = [df.groupBy(DAY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("mmsi").alias("n_vessels"))
             .select(F.lit(name).alias("table_name"), DAY, "n_rows", "n_vessels")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name", DAY)


def file_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Pieces and bytes per place: files, bytes and rows of each day folder of tables in the day layout.

    Only the scan's file metadata is selected, so no data column is read: rows are counted
    from the files' footers. A file counts once, however many splits it is read in.
    """
    parts = []
    for name, df in tables.items():
        files = (df.select(DAY, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
                 .groupBy(DAY, "file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n")))
        parts.append(files.groupBy(DAY).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"), F.sum("n").alias("n_rows"))
                     .select(F.lit(name).alias("table_name"), DAY, "n_files", "n_bytes", "n_rows"))
    return reduce(DataFrame.unionByName, parts).orderBy("table_name", DAY)


def sample_mmsi(df: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` rows' vessel ids in (mmsi, ts, row_id) order (a top-k, not a full sort)."""
    return (df.filter(F.col("mmsi").isNotNull() & (F.col("mmsi") != 0))
            .orderBy("mmsi", "ts", "row_id").limit(k)
            .select(F.col("mmsi")))


def first_vessel(df: DataFrame) -> int | None:
    """The lowest vessel id present (one scalar to the driver), or None."""
    return df.filter(F.col("mmsi").isNotNull()).agg(F.min("mmsi")).first()[0]


def vessel_reports(df: DataFrame, mmsi: int | None, k: int = 5) -> DataFrame:
    """The first ``k`` reports of one vessel: row_id, mmsi, ts.

    The equality on a literal is pushed into the Parquet scan, so on a
    vessel-ordered table (min/max statistics per file and row group) the lookup
    skips the data of other vessels.
    """
    return (df.filter(F.col("mmsi") == F.lit(mmsi).cast("bigint"))
            .orderBy("ts", "row_id").limit(k)
            .select("row_id", "mmsi", "ts"))


def gap_lookup(gaps: DataFrame, mmsi: int | None, since: Column, until: Column, longer_than: int) -> DataFrame:
    """Gap rows by vessel, by time and by gap length, each with the name of its filter.

    All three are comparisons with literals, which the Parquet scan uses to skip row groups; on an
    interleaved copy (:mod:`wakeline.sources.interleave`) each of them skips most.
    """
    filters = {
        "vessel": F.col("mmsi") == F.lit(mmsi).cast("bigint"),
        "time": (F.col("ts") >= since) & (F.col("ts") < until),
        "gap": F.col("delta_t_ms") > F.lit(longer_than).cast("bigint"),
    }
    parts = [gaps.where(f).select(F.lit(name).alias("lookup"), "row_id", "mmsi", "ts", "delta_t_ms") for name, f in filters.items()]
    return reduce(DataFrame.unionByName, parts)


def vessel_lookup(df: DataFrame, k: int = 5) -> DataFrame:
    """First vessel present (lowest mmsi) and its first ``k`` reports (find one, then query it)."""
    return vessel_reports(df, first_vessel(df), k)
