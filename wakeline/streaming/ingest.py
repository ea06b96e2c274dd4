"""Incremental load: CSV files landing in a folder -> the raw positions table.

A Structured Streaming file source discovers new files and keeps the exactly-once
bookkeeping in its checkpoint.  Each micro-batch is one load of a load table
(:mod:`wakeline.sources.loads`): its files are read with the batch CSV reader, grouped by each
file's own header, so columns are bound by header name as in the original per-file reader (a streaming CSV
source needs a fixed schema and would bind by position), then parsed and checked with
:func:`positions_raw`. Row ids are unique over all batches, so the rows can go to the gap operator
and the merges as they are. A batch that is run again after a failure overwrites what it had written, or, if it
was recorded already, finds that its files are known.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.config import DEFAULT_CONFIG, AisConfig
from wakeline.session import checkpoint_dir
from wakeline.sources.csv import literal_path
from wakeline.sources.loads import append_load

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# files per micro-batch (each file's header is read once per batch)
DEFAULT_FILES_PER_TRIGGER = 200


def new_files(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None,
              glob: str = "*.csv") -> DataFrame:
    """Stream of newly landed CSV file paths: one row per file (file content is not read here)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", str(max_files_per_trigger or DEFAULT_FILES_PER_TRIGGER)))
    return reader.load(src_dir).select(F.col("path").alias("_file"))


def start_raw_ingest(spark: SparkSession, src_dir: str, out_path: str, cfg: AisConfig = DEFAULT_CONFIG,
                     checkpoint_location: str | None = None, available_now: bool = True,
                     max_files_per_trigger: int | None = None, glob: str = "*.csv") -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``out_path`` becomes a load table, read with :func:`wakeline.sources.loads.read_rows`.
    ``glob`` selects the landed files (e.g. ``"*.csv.gz"`` for compressed days).
    """
    location = checkpoint_location or os.path.join(checkpoint_dir(spark), "raw-ingest-stream")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # file names only (at most maxFilesPerTrigger of them), not rows
        files = sorted(r._file for r in batch.collect())
        if not files:
            return
        append_load(spark, out_path, [literal_path(f) for f in files], cfg)

    writer = (new_files(spark, src_dir, max_files_per_trigger, glob)
              .writeStream.foreachBatch(write_batch).option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
