"""Per-query stage report from Spark's event log (written to a fresh folder under /tmp).

For each headline query (run once warm): Spark jobs and stages, summed task
time, shuffle bytes written, and the largest task's share of its stage time.

Usage: python tools/stage_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

DEFAULT = ["ais_positions_raw", "ais_valid_vessels", "ais_positions_clean", "ais_delta_t", "ais_delta_histogram"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    log_dir = tempfile.mkdtemp(prefix="wakeline-stages-")
    spark = (SparkSession.builder.master("local[8]").appName("stage-report")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.hugeMethodLimit", "8000").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from wakeline.plans.queries import QUERIES

    QUERIES["ais_positions_raw"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    job_group, stage_job, tasks, shuffle_w, stage_ms = {}, {}, {}, {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    job_group[ev["Job ID"]] = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    info, m = ev.get("Task Info") or {}, ev.get("Task Metrics") or {}
                    dur = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                    tasks.setdefault(ev["Stage ID"], []).append(dur)
                    shuffle_w[ev["Stage ID"]] = shuffle_w.get(ev["Stage ID"], 0) + \
                        (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    stage_ms[si["Stage ID"]] = si.get("Completion Time", 0) - si.get("Submission Time", 0)
    print(f"event log: {log_dir}")
    print(f"{'query':22s} {'jobs':>4s} {'stages':>6s} {'task s':>7s} {'stage s':>7s} {'shuffle MB':>10s} {'max task/stage':>14s}")
    for name in names:
        stages = [s for s, j in stage_job.items() if job_group.get(j) == name and s in tasks]
        jobs = {stage_job[s] for s in stages}
        task_s = sum(sum(tasks[s]) for s in stages) / 1000
        wall_s = sum(stage_ms.get(s, 0) for s in stages) / 1000
        mb = sum(shuffle_w.get(s, 0) for s in stages) / 1e6
        skew = max((max(tasks[s]) / max(1, sum(tasks[s])) for s in stages if len(tasks[s]) > 1), default=0)
        print(f"{name:22s} {len(jobs):4d} {len(stages):6d} {task_s:7.2f} {wall_s:7.2f} {mb:10.2f} {skew:14.2f}")


if __name__ == "__main__":
    main()
