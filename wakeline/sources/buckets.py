"""Co-located placement by vessel (S9): bucketed, sorted tables whose joins and counts need no shuffle of the large side.

Rows are placed by the hash of (vessel, piece). ``piece`` is 0 but for vessels with more rows than a bucket should
hold: their rows are dealt over several pieces by ``row_id``. A key table that takes part in a join lists
every piece of a vessel, so the join on (vessel, piece) finds all rows where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.sources.tables import write_stage

KEY, PIECE = "mmsi", "piece"


@dataclass(frozen=True)
class Placed:
    """A bucketed table in the session's catalog, and the vessels that lie in several pieces (``mmsi, pieces``)."""

    name: str
    columns: tuple[str, ...]
    large: DataFrame

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows, with ``piece``."""
        return spark.table(self.name)


def place_by_vessel(df: DataFrame, name: str, path: str, buckets: int, rows_per_piece: int) -> Placed:
    """Write ``df``, a stored table with ``mmsi``, ``ts`` and ``row_id``, as the bucketed table ``name`` at ``path``.

    At most ``rows / rows_per_piece`` vessels have several pieces, whatever the data. Every bucket is
    one sorted file of one task. Rows without a vessel lie in pieces like those of any vessel.
    """
    counts = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_piece)
    large = write_stage(counts.select(KEY, F.ceil(F.col("n") / rows_per_piece).cast("int").alias("pieces")), "large-vessels")
    of_row = large.select(F.col(KEY).alias("_key"), "pieces")
    dealt = (df.join(of_row, df[KEY].eqNullSafe(of_row["_key"]), "left")
             .withColumn(PIECE, F.coalesce(F.pmod(F.xxhash64("row_id"), F.col("pieces")).cast("int"), F.lit(0))))
    (dealt.select(*df.columns, PIECE).repartition(buckets, KEY, PIECE)
     .write.mode("overwrite").bucketBy(buckets, KEY, PIECE).sortBy(KEY, "ts").option("path", path).saveAsTable(name))
    return Placed(name, tuple(df.columns), large)


def counts_in_place(placed: Placed, spark: SparkSession, condition) -> DataFrame:
    """``mmsi, n_reports`` of the rows that fulfil ``condition``: counted where they lie, only the counts are shuffled."""
    per_piece = placed.rows(spark).where(condition).groupBy(KEY, PIECE).agg(F.count(F.lit(1)).alias("n"))
    return per_piece.groupBy(KEY).agg(F.sum("n").alias("n_reports"))


def semi_join_in_place(placed: Placed, spark: SparkSession, keys: DataFrame) -> DataFrame:
    """Rows whose vessel is in ``keys(mmsi)``. The placed table is not shuffled: the keys come to its buckets
    (or to all tasks, where Spark finds them small enough to broadcast)."""
    listed = (keys.select(KEY).distinct().join(placed.large, KEY, "left")
              .select(KEY, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)).alias(PIECE)))
    return placed.rows(spark).join(write_stage(listed, "keys"), [KEY, PIECE], "left_semi").select(*placed.columns)


def drop_placed(spark: SparkSession, placed: Placed) -> None:
    """Take the table out of the catalog; its files go with the folder they lie in."""
    spark.sql(f"DROP TABLE IF EXISTS {placed.name}")
