"""Fixed-width gap histogram (A8) and its summary counts (A9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, AisConfig


def _bin_index(d, cfg: AisConfig):
    # left-closed equal bins on [0, range]; the last bin also holds `range` itself
    return F.least(F.floor(d * F.lit(cfg.hist_bins) / F.lit(cfg.hist_range_ms)),
                   F.lit(cfg.hist_bins - 1)).cast("int")


def gap_histogram(dt: DataFrame, cfg: AisConfig = DEFAULT_CONFIG, value: str = "delta_t_ms") -> DataFrame:
    """One row per bin (empty bins included): bin, bin_start_ms, bin_end_ms, n.

    Counting is a partial + final aggregate over at most ``hist_bins`` keys, so
    every map task ships at most that many rows; the bin table is joined to the
    bounded count table (at most ``hist_bins`` rows) by broadcast.
    """
    d = F.col(value)
    counts = (dt.filter(d.isNotNull() & (d >= 0) & (d <= cfg.hist_range_ms))
              .groupBy(_bin_index(d, cfg).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    spark = dt.sparkSession
    bins = spark.range(cfg.hist_bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.col("id") * cfg.hist_range_ms / cfg.hist_bins).cast("bigint").alias("bin_start_ms"),
        ((F.col("id") + 1) * cfg.hist_range_ms / cfg.hist_bins).cast("bigint").alias("bin_end_ms"))
    return (bins.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_start_ms", "bin_end_ms", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def gap_summary(dt: DataFrame, cfg: AisConfig = DEFAULT_CONFIG, value: str = "delta_t_ms") -> DataFrame:
    """All non-negative gaps (the plotted total), those inside the range and above it."""
    d = F.col(value)
    return (dt.filter(d.isNotNull() & (d >= 0))
            .agg(F.count(F.lit(1)).alias("n_plotted"),
                 F.count_if(d <= cfg.hist_range_ms).alias("n_in_range"),
                 F.count_if(d > cfg.hist_range_ms).alias("n_above_range"),
                 F.count_if(d == 0).alias("n_zero"),
                 F.min(d).alias("min_delta_ms"),
                 F.max(d).alias("max_delta_ms")))
