"""Run headline queries with Spark's event log on (in a fresh scratch folder)
and print per-query task time, stage count and shuffle bytes.

    python tests/eventlog_summary.py [sf_dir] [key ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="voxlens-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("voxlens-eventlog")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    import bench
    import __spark_entry__ as entry

    keys = argv[1:] or list(bench.HEADLINE)
    qs = entry.queries()
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"# {key}: {time.perf_counter() - t0:.2f}s wall", file=sys.stderr)
    spark.stop()

    stats: dict[str, dict[str, float]] = {}
    job_group: dict[int, str] = {}
    stage_job: dict[int, str] = {}
    for path in [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    g = stage_job.get(ev.get("Stage ID"), "?")
                    m = ev.get("Task Metrics") or {}
                    s = stats.setdefault(g, {"tasks": 0, "task_ms": 0, "shuffle_write_mb": 0.0, "stages": set()})
                    s["tasks"] += 1
                    s["task_ms"] += m.get("Executor Run Time", 0)
                    s["shuffle_write_mb"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0) / 1e6
                    s["stages"].add(ev.get("Stage ID"))
    print(f"{'query':26s} {'stages':>6s} {'tasks':>6s} {'task s':>7s} {'shuffle MB':>10s}")
    for key in keys:
        s = stats.get(key)
        if s:
            print(f"{key:26s} {len(s['stages']):6d} {s['tasks']:6d} {s['task_ms'] / 1000:7.2f} "
                  f"{s['shuffle_write_mb']:10.2f}")


if __name__ == "__main__":
    main(sys.argv[1:])
