"""Per-vessel report counts (A1), the validity threshold (A2) and the clean table (J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, AisConfig
from wakeline.functions.predicates import stored_row_counts
from wakeline.operators.joins import semi_join_stored


def vessel_counts(raw: DataFrame, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    """Counted reports per vessel.  Partial aggregation runs before the shuffle, so a
    vessel holding a third of all rows still ships one row per map task."""
    return (raw.filter(stored_row_counts(cfg))
            .groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_reports")))


def valid_vessels(raw: DataFrame, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    return vessel_counts(raw, cfg).filter(F.col("n_reports") >= cfg.min_reports)


def positions_clean(raw: DataFrame, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    """Whole raw rows of valid vessels (NaN rows of a valid vessel included).

    The valid set has at most rows/min_reports entries; it is written first, and
    Spark's byte limit decides whether it is broadcast.
    """
    keys = valid_vessels(raw, cfg).select("mmsi")
    return semi_join_stored(raw, keys, "mmsi")
