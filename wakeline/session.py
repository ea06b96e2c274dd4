"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wakeline") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # local data is small: without this, AQE folds a 1-2 MB shuffle into one task
        # (its 1 MB minimum), serializing the stages after it; clusters keep the default
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # generated methods above HotSpot's 8000-bytecode JIT limit would run interpreted;
        # with this limit such stages use per-operator code the JIT does compile
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``), read from the session.

    Where it is unset, a private folder is made for a local master only; on a cluster,
    whose executors would each see another disk, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset: {sc.master} needs a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wakeline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


_SCRATCH: list[str] = []
_TABLES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared checkpoint folder."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh path for an intermediate table, and a name for it in the session's catalog."""
    path = scratch_path(spark, name)
    _TABLES.append(os.path.basename(path).replace("-", "_"))
    return path, _TABLES[-1]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark's file systems reach it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has made; frames read from them are void then."""
    n = len(_SCRATCH)
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
    return n
