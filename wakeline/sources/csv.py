"""CSV position logs: every file bound by its own header line (S1), unique row ids (S8)."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wakeline.config import AIS_HEADERS
from wakeline.sources.tables import write_stage

# RFC 4180 quoting (doubled quotes), as written by common CSV tools.
CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "encoding": "UTF-8"}
MALFORMED = "malformed"
_BROKEN = "_broken_record"
FILES_PER_TASK = 64  # heads that a task opens


def input_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, bytes, modified`` of every file under ``paths``: a listing, no content is read."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def literal_path(file: str) -> str:
    """A path that names this very file, whatever pattern characters its name holds."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", file)


def _head_reader() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function: ``file`` to ``file, header`` (its first line that is not blank), opening just the head of each file.

    A file of a kind that Arrow cannot open gets a null header, a file without such a line none.
    A closure, so that executors need no copy of this package.
    """
    def read(batches):
        import pyarrow
        from pyarrow import fs

        def first_line(file):
            scheme, _, rest = file.partition(":")
            if scheme == "file":
                store, path = fs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                host, _, inside = rest.lstrip("/").partition("/")
                store, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
                path = root + inside
            text = b""
            with store.open_input_stream(path, compression="detect", buffer_size=1 << 16) as stream:
                while chunk := stream.read(1 << 16):
                    text += chunk
                    lines = text.split(b"\n")
                    for line in lines[:-1]:
                        if line.strip():
                            return line
                    text = lines[-1]
            return text if text.strip() else None

        for batch in batches:
            found = []
            for file in batch.column("file").to_pylist():
                try:
                    line = first_line(file)
                    if line is not None:
                        found.append((file, line.rstrip(b"\r").decode("utf-8", "replace")))
                except (OSError, ValueError, pyarrow.ArrowException):
                    found.append((file, None))
            yield pyarrow.record_batch({"file": pyarrow.array([f for f, _ in found], pyarrow.string()),
                                        "header": pyarrow.array([h for _, h in found], pyarrow.string())})
    return read


def header_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``header, file``: the first line that is not blank of each file that has one, as a stored table.

    Tasks take blocks of file names and open the head of each file: some 64 KB are read per file,
    whatever its size. Files in a store that only Spark's readers open are read as lines (:func:`scanned_headers`).
    """
    files = input_files(spark, paths).select("file")
    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    found = write_stage(files.repartition(tasks).mapInArrow(_head_reader(), "file string, header string"), "headers")
    closed = [literal_path(r["file"]) for r in found.where("header IS NULL").collect()]  # file names, usually none
    known = found.where("header IS NOT NULL").select("header", "file")
    return known.unionByName(write_stage(scanned_headers(spark, closed), "headers")) if closed else known


def scanned_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``header, file`` by a scan of all lines. The first line is the one of the lowest id that the scan gives
    its rows: ids rise inside a split, so neither a sort nor a spill decides."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("id"), "value")
    firsts = (lines.where((F.col("at") == 0) & (F.trim("value") != ""))
              .groupBy("uri").agg(F.min_by(F.regexp_replace("value", "\r$", ""), "id").alias("header")))
    return firsts.select("header", F.url_decode(F.regexp_replace("uri", "[+]", "%2B")).alias("file"))


def _read_with_header(spark: SparkSession, paths: str | list[str], header: str, header_map, multiline: bool) -> DataFrame:
    names = next(csv.reader([header.lstrip("\ufeff")]))
    place = {name: i for i, name in enumerate(names)}  # of a repeated name the last column counts
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))] + [StructField(_BROKEN, StringType())])
    raw = (spark.read.options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", "false")
           .option("multiLine", str(multiline).lower()).schema(schema).csv(paths))
    cols = [F.coalesce(F.col(f"_c{place[h]}"), F.lit("")).alias(f) if h in place else F.lit("").alias(f) for f, h in header_map]
    # Spark marks broken records only where some field is read too: the length makes sure of that
    broken = F.col(_BROKEN).isNotNull() & (F.length(F.coalesce(F.col("_c0"), F.lit(""))) >= 0)
    return raw.select(*cols, broken.alias(MALFORMED))


def read_csv_strings(spark: SparkSession, paths: str | list[str], header_map=AIS_HEADERS, multiline: bool = False) -> DataFrame:
    """Rows of field-named strings plus ``malformed``; each file's columns are bound by its own header.

    A header missing from a file reads as '' for its rows, and so does an empty or
    missing cell. ``malformed`` marks a record with more or fewer cells than its header.
    Files are grouped by header line and every group is one scan, so files of one
    layout are one scan in all. The files are those that are there when the headers are read, named
    one by one where there are several layouts, so names may hold blanks and pattern characters.

    ``multiline`` reads quoted cells that hold line breaks; files are then not split, so a
    file is one task. Without it such a record falls apart into malformed ones.
    """
    heads = header_lines(spark, paths)
    layouts = sorted(r["header"] for r in heads.select("header").distinct().collect())  # one per layout
    if not layouts:
        return spark.createDataFrame([], ", ".join([*(f"{f} string" for f, _ in header_map), f"{MALFORMED} boolean"]))
    if len(layouts) == 1:
        return _read_with_header(spark, paths, layouts[0], header_map, multiline)
    # several layouts: file names of each (names, not rows)
    parts = [_read_with_header(spark, sorted(literal_path(r["file"]) for r in heads.where(F.col("header") == h).select("file").collect()),
                               h, header_map, multiline) for h in layouts]
    return reduce(DataFrame.unionByName, parts)


SPLIT_BITS = 33  # of a row id that count the rows of one split


def read_ais_csv(spark: SparkSession, paths: str | list[str], multiline: bool = False, first_split: int = 0) -> DataFrame:
    """Field-named string rows with a unique ``row_id``.

    An id holds the number of the row's split and the row's place in it. Splits are numbered from
    ``first_split`` on, so loads that are given different numbers have different ids
    (:mod:`wakeline.sources.loads`). Ids are made to be written with the rows (the raw table), which is read back
    from then on. Rows of equal time are ordered by them, in no promised order between files.
    """
    return read_csv_strings(spark, paths, multiline=multiline).withColumn(
        "row_id", F.monotonically_increasing_id() + F.lit(first_split << SPLIT_BITS))


def observed(strings: DataFrame) -> tuple[DataFrame, Observation]:
    """``strings`` with the rows read and the malformed records counted as they pass."""
    seen = Observation("load")
    malformed = F.count_if(F.col(MALFORMED)) if MALFORMED in strings.columns else F.count_if(F.lit(False))
    return strings.observe(seen, F.count(F.lit(1)).alias("rows_read"), malformed.alias("rows_malformed")), seen


def write_ais_csv(rows: DataFrame, path: str, header_map=AIS_HEADERS, n_files: int | None = None, in_order: bool = False) -> None:
    """Write field-named string rows as CSV with the real headers, in ``row_id`` order.

    Cell text is written verbatim (no whitespace trimming). Rows that are ``in_order`` already are
    written as they lie, a file per partition.
    """
    out = rows
    if not in_order:
        ranged = rows.repartitionByRange(n_files, "row_id") if n_files else rows.repartitionByRange("row_id")
        out = ranged.sortWithinPartitions("row_id")
    (out.select(*(F.col(f).alias(h) for f, h in header_map))
     .write.mode("overwrite").options(**CSV_OPTIONS)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
