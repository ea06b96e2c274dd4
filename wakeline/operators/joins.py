"""Joins against a key table that is written first, so that its size is measured."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wakeline.sources.tables import write_stage


def semi_join_stored(big: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """``big`` rows whose key is (semi) or is not (anti) in ``keys``.

    The key table is written as a stage: the plan behind it runs once, and Spark
    knows its bytes. It broadcasts it only under its own size limit
    (``spark.sql.autoBroadcastJoinThreshold``); above that both sides shuffle on the key,
    where AQE splits a hot key of the large side.
    """
    return big.join(write_stage(keys, "keys"), on, how).select(*big.columns)
