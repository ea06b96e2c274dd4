"""One copy of a table that serves filters on several columns (S10): rows in the order of interleaved ranks.

A sort by (vessel, time) lets a reader skip row groups for a vessel, but not for a time alone or a gap
length. Here each column's values are cut into ranges of about equal row counts, and rows are ordered
by the bits of the range numbers taken in turn (a Z-order curve). Every file, and every row group in it, then
covers a small box in all the columns, so its minima and maxima exclude most filters on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_BITS = 8
#: of the quantiles that cut a column, against the number of rows; a cut may be off by that share
ACCURACY = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """The column as a double that keeps its order."""
    kind = df.schema[column].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    return F.col(column).cast("double")


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> list[list[float]]:
    """Ascending inner bounds of each column's ranges, at most ``2 ** bits - 1`` of them: one aggregate over the table."""
    shares = F.array(*(F.lit(k / 2 ** bits) for k in range(1, 2 ** bits)))
    found = df.agg(*(F.percentile_approx(_number(df, c), shares, ACCURACY).alias(c) for c in columns)).first()
    return [sorted({v for v in found[c] or [] if v == v and abs(v) != float("inf")}) for c in columns]


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """The bits of the ranks taken in turn, highest first, as one number."""
    n = len(ranks)
    picked = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("bigint")), b * n + (n - 1 - i))
              for i, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), picked)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str] = ("mmsi", "ts", "delta_t_ms"), order_id: str = "row_id",
                      rows_per_file: int = 2_000_000, mode: str = "overwrite") -> None:
    """Write ``df``, a stored table, in interleaved order of up to seven columns; ``order_id`` splits what is equal in all of them.

    Files are ranges of that order, so equal values of one column, however many, are dealt over files by the
    others. Nulls and NaN have a range of their own.
    """
    bounds = rank_bounds(df, columns)
    marks = [f"_rank{i}" for i in range(len(columns))]
    ranked = df.withColumns({f"_value{i}": _number(df, c) for i, c in enumerate(columns)})
    cuts = [[float("-inf"), *b, float("inf")] if b else [float("-inf"), 0.0, float("inf")] for b in bounds]
    ranked = Bucketizer(splitsArray=cuts, inputCols=[f"_value{i}" for i in range(len(columns))], outputCols=marks,
                        handleInvalid="keep").transform(ranked)
    # a column of few values has few ranges: their numbers are stretched, so that the highest bits of every column tell
    ranks = [F.floor(F.col(m) * (2 ** RANK_BITS / len(c))).cast("bigint") for m, c in zip(marks, cuts)]
    z = interleaved(ranks)
    width = max(1, -(-df.count() // rows_per_file))
    (ranked.withColumn("_z", z).repartitionByRange(width, "_z", order_id).sortWithinPartitions("_z", order_id)
     .select(df.columns).write.mode(mode).parquet(path))
