"""Skew check from Spark's event log: largest task (records read) per shuffle stage.

On a skewed derivation of the fixture -- every third raw row re-assigned to one vessel, so
that vessel holds a third of all rows -- runs the gap operator, the registered
composition of clean and gaps on the shuffled branch, and a plain ``lag`` over
``Window.partitionBy("mmsi")``; and the gap operator on events of which a third fall into
one hour of one user. The event log goes to a fresh folder under /tmp.  For each job it prints, per stage that reads a shuffle, the
largest and the median number of records read by one task.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="wakeline-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             # AQE's skew thresholds scaled down to this data size (defaults: 256 MB, 5x median)
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from wakeline.operators.positions import positions_raw
    from wakeline.operators.sequence import with_previous_time
    from wakeline.sources.fixture import ais_strings
    from wakeline.sources.tables import write_stage

    raw = positions_raw(ais_strings(spark, sf_dir))
    skewed = write_stage(raw.withColumn("mmsi", F.when(F.col("row_id") % 3 == 0, F.lit(219999999))
                                        .otherwise(F.col("mmsi"))), "skewed")
    n = skewed.count()
    hot = skewed.filter(F.col("mmsi") == 219999999).count()

    from wakeline.config import AisConfig
    from wakeline.operators.sequence import positions_dt
    from wakeline.operators.vessels import positions_clean

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    cfg = AisConfig(min_reports=1)
    spark.sparkContext.setJobGroup("skew_safe", "gaps of the stored table")
    noop(with_previous_time(skewed))
    spark.sparkContext.setJobGroup("clean_and_gaps", "clean on the shuffled branch, written, then gaps")
    noop(positions_dt(write_stage(positions_clean(skewed, cfg), "skewed-clean"), cfg))
    spark.sparkContext.setJobGroup("busy_hour", "events of one user within one hour, a third of all")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    busy = write_stage(ev.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.timestamp_micros(
        F.lit(1_776_000_000_000_000) + F.pmod(F.xxhash64("event_id"), F.lit(3_600_000_000)))).otherwise(F.col("ts")))
        .withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))), "busy")
    noop(with_previous_time(busy, key="user_id", ts="ts", order_id="event_id"))
    busy_rows = busy.count()
    spark.sparkContext.setJobGroup("plain_window", "plain window lag")
    (skewed.withColumn("prev_ts", F.lag("ts").over(Window.partitionBy("mmsi").orderBy("ts", "row_id")))
     .write.format("noop").mode("overwrite").save())
    spark.stop()

    stage_group, tasks = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if recs:
                        tasks.setdefault(ev["Stage ID"], []).append(recs)
    print(f"rows {n}, hot vessel rows {hot} ({hot / n:.0%}); event log: {log_dir}")
    shares = {}
    for group in ("skew_safe", "clean_and_gaps", "busy_hour", "plain_window"):
        worst = 0
        for sid in sorted(s for s, g in stage_group.items() if g == group and s in tasks and sum(tasks[s]) > 1000):
            r = tasks[sid]
            worst = max(worst, max(r))
            print(f"  {group:13s} stage {sid:3d}: tasks {len(r):3d}  max records/task {max(r):7d}"
                  f"  median {int(statistics.median(r)):7d}")
        print(f"  {group}: largest task reads {worst} records = {worst / n:.0%} of all rows")
        shares[group] = worst / (busy_rows if group == "busy_hour" else n)
    print("SKEW " + " ".join(f"{g}={v:.3f}" for g, v in shares.items()) + f" hot={hot / n:.3f}")


if __name__ == "__main__":
    main()
