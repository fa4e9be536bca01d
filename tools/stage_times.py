"""Stage and task times of registered queries, from Spark's event log.

Usage: python tools/stage_times.py [sf_dir] key [key ...]
The event log goes to a fresh folder under /tmp (no UI, no server).  Each
query runs once as a warm-up and once measured, with its jobs tagged by a
job description; per query it prints the jobs, stages and tasks and the
stages that took longest.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tollflow.registry import QUERIES  # noqa: E402
from tollflow.session import local_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = local_session(extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for k in args:
        for tag in (f"warmup:{k}", k):
            spark.catalog.clearCache()
            sc.setJobDescription(tag)
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    stage_key, jobs = {}, defaultdict(int)
    stages = defaultdict(list)
    tasks = defaultdict(int)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    tag = (ev.get("Properties") or {}).get("spark.job.description", "")
                    if tag in args:
                        jobs[tag] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_key[sid] = tag
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    key = stage_key.get(info["Stage ID"])
                    if key and "Completion Time" in info and "Submission Time" in info:
                        ms = info["Completion Time"] - info["Submission Time"]
                        stages[key].append((ms, info["Number of Tasks"], info["Stage Name"]))
                        tasks[key] += info["Number of Tasks"]
    for k in args:
        st = sorted(stages[k], reverse=True)
        print(f"{k}: jobs={jobs[k]} stages={len(st)} tasks={tasks[k]} "
              f"stage_ms_sum={sum(s[0] for s in st)}")
        for ms, n, name in st[:3]:
            print(f"    {ms:6d} ms  {n:4d} tasks  {name[:70]}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
