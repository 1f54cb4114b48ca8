"""Shuffle volume per bench workload, from Spark's event log.

usage: python scripts/shuffle_report.py [sf_dir]

Runs the workloads of bench.py once with the event log written to a fresh
scratch folder, then sums per job group: bytes read by scans, shuffle bytes
written, and the largest single task's shuffle read.  A workload that
shuffles close to nothing next to what it scans moves summaries, not rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    os.environ["BENCH_SF_DIR"] = sf
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    import bench
    from tessera import local_session

    spark = local_session(8, app="tessera-shuffle-report", shuffle_partitions=16, driver_memory="16g",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for name, fn in bench.QUERIES.items():
        sc.setJobGroup(name, name)
        fn(spark)
    spark.stop()

    job_group, stage_job = {}, {}
    read, shuffle_w, max_task_read = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    group = job_group.get(stage_job.get(ev.get("Stage ID")))
                    m = ev.get("Task Metrics") or {}
                    read[group] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    shuffle_w[group] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    sr = m.get("Shuffle Read Metrics") or {}
                    task_read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    max_task_read[group] = max(max_task_read[group], task_read)
    print(f"{'workload':<20}{'scan MB':>10}{'shuffle MB':>12}{'ratio':>8}{'max task shuffle-read MB':>27}")
    for name in bench.QUERIES:
        r, w = read[name] / 1e6, shuffle_w[name] / 1e6
        ratio = w / r if r else float("nan")
        print(f"{name:<20}{r:>10.1f}{w:>12.2f}{ratio:>8.3f}{max_task_read[name] / 1e6:>27.2f}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
