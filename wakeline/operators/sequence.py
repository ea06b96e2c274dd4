"""Previous report time per vessel (W1) and the gap table (C3), skew-safe.

Semantics: within a vessel, rows are ordered by (ts, row_id); each row gets the
ts of the row before it (null for the vessel's first row).

A plain ``lag`` over ``Window.partitionBy("mmsi")`` sends a whole vessel to one
task, which breaks when one vessel (or one burst of copies) holds a large share
of the rows.  Instead:

1. The rows are put in order over range partitions of (mmsi, ts, row_id), in one shuffle. Row ids
   are unique, so ranges are of equal size whatever vessel, or one time of it, holds the rows.
2. A range is written as one bucket of a sorted table, so the window over a range needs no second
   shuffle.
3. The previous row is a lag inside the range; a range's first row takes the last row of the
   range before it, from a table of one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT_CONFIG, AisConfig
from wakeline.sources.tables import write_bucketed, write_stage


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a timestamp_ntz wall time, truncated to the ms.

    Built from date and time-of-day fields, so it does not depend on the session
    time zone (casting timestamp_ntz to timestamp would, across DST changes).
    """
    t = ts if isinstance(ts, Column) else F.col(ts)
    day_ms = F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000)
    clock_ms = F.hour(t) * F.lit(3_600_000) + F.minute(t) * F.lit(60_000)
    sec_ms = F.floor(F.date_part(F.lit("SECOND"), t) * F.lit(1000))
    return (day_ms + clock_ms + sec_ms).cast("bigint")


def ms_between(start: Column | str, end: Column | str) -> Column:
    """Whole milliseconds from start to end: each side truncated to the ms, then subtracted."""
    return epoch_millis(end) - epoch_millis(start)


def with_previous_time(df: DataFrame, key: str = "mmsi", ts: str = "ts", order_id: str = "row_id",
                       out: str = "prev_ts", rows_per_range: int = 1_000_000) -> DataFrame:
    """``df`` plus ``out`` = ts of the previous row of the same key in (ts, order_id) order.

    ``order_id`` must be unique (row ids are). Rows with a null key or time are
    not returned (callers filter them first). ``df`` is read twice, once for a sample of the
    three columns: it should be a stored table.
    """
    spark = df.sparkSession
    # a stored table's rows are counted from its footers
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_range))
    ordered = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).repartitionByRange(width, key, ts, order_id)
    ranged = write_bucketed(ordered.withColumn("_part", F.spark_partition_id()), "time-ranges", width, "_part", [key, ts, order_id])

    inside = Window.partitionBy("_part").orderBy(key, ts, order_id)
    # one row per range: a window and a broadcast of at most ``width`` rows
    ends = ranged.groupBy("_part").agg(F.max(F.struct(key, ts)).alias("_end"))
    before = write_stage(ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_before")), "range-ends")
    previous = F.coalesce(F.lag(F.struct(key, ts)).over(inside), F.col("_before"))
    return (ranged.join(F.broadcast(before), "_part").withColumn("_p", previous)
            .select(*df.columns, F.when(F.col(f"_p.{key}") == F.col(key), F.col(f"_p.{ts}")).alias(out)))


def positions_dt(clean: DataFrame, cfg: AisConfig = DEFAULT_CONFIG) -> DataFrame:
    """Clean rows plus ``prev_ts`` and ``delta_t_ms``; each vessel's first report is dropped."""
    cols = clean.columns
    keyed = clean.filter(F.col("mmsi").isNotNull() & F.col("ts").isNotNull())
    with_prev = with_previous_time(keyed)
    return (with_prev.filter(F.col("prev_ts").isNotNull())
            .select(*cols, "prev_ts", ms_between("prev_ts", "ts").alias("delta_t_ms")))
