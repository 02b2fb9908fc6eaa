"""Jobs, stages, tasks, input and shuffle bytes per bench workload, from Spark's event log.

    python tools/measure.py [sf_dir]

Runs each workload of ``bench.py`` once (after a warm-up pass) under its own job group with
the event log written to a fresh scratch folder, then sums the task metrics per group.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from auditlane.session import ensure_lake_root  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="auditlane-eventlog-")
    spark = bench.session(8, {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                   "spark.eventLog.compress": "false"})
    root = ensure_lake_root(spark)
    workloads = bench.build_workloads(spark, sf_dir, root)
    for _, fn in workloads:  # warm-up (also creates the frozen batch)
        fn()
    sc = spark.sparkContext
    for name, fn in workloads:
        sc.setJobGroup(name, name)
        fn()
    sc.setJobGroup("", "")
    spark.stop()

    files = sorted(
        (f for f in glob.glob(f"{log_dir}/**/*", recursive=True)
         if os.path.isfile(f) and "appstatus" not in os.path.basename(f)),
        key=lambda f: [int(x) if x.isdigit() else x for x in os.path.basename(f).split("_")],
    )
    job_group, stage_job = {}, {}
    stats = defaultdict(lambda: defaultdict(int))
    for line in (ln for path in files for ln in open(path)):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            if group:
                job_group[ev["Job ID"]] = group
                stats[group]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = group
        elif kind == "SparkListenerStageCompleted":
            sid = ev["Stage Info"]["Stage ID"]
            if sid in stage_job:
                stats[stage_job[sid]]["stages"] += 1
        elif kind == "SparkListenerTaskEnd":
            group = stage_job.get(ev.get("Stage ID"))
            m = ev.get("Task Metrics") or {}
            if group and m:
                stats[group]["tasks"] += 1
                stats[group]["input_bytes"] += m.get("Input Metrics", {}).get("Bytes Read", 0)
                stats[group]["shuffle_write_bytes"] += m.get("Shuffle Write Metrics", {}).get(
                    "Shuffle Bytes Written", 0)
                stats[group]["shuffle_records"] += m.get("Shuffle Write Metrics", {}).get(
                    "Shuffle Records Written", 0)
                stats[group]["output_bytes"] += m.get("Output Metrics", {}).get("Bytes Written", 0)
    print(json.dumps({name: dict(stats[name]) for name, _ in workloads}, indent=1))


if __name__ == "__main__":
    main()
