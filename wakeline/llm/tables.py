"""Stage tables of the corpus operators: written once to the shared folder and read back."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

import wakeline
from wakeline.session import scratch_path


def ship_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver runs from another folder.

    On a cluster the package is installed or sent along (``--py-files``); the path added
    here is then one more that holds nothing.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(wakeline.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    The plan runs once, later readers are cut off from its lineage, and a lost
    executor costs a re-read of the file instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions for ``rows`` rows: the session's width, more when the data needs it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))
