"""Summarise a Spark event log: per job description, the number of jobs and
stages, summed stage time, and the worst task skew (max / median task time)
of any stage with several tasks.

    python tools/stages.py <event-log-file-or-folder>
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of one event log file, or of a rolling log folder in order."""
    if os.path.isdir(path):
        parts = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        paths = [os.path.join(path, f) for f in parts]
    else:
        paths = [path]
    for p in paths:
        if p.endswith(".zstd"):
            import io
            import zstandard
            with open(p, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(p) as fh:
                yield from fh


def main(path: str) -> None:
    job_desc, stage_job = {}, {}
    stage_time, task_times = {}, defaultdict(list)
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description", "-")
            job_desc[ev["Job ID"]] = desc
            for sid in ev.get("Stage IDs", []):
                stage_job[sid] = ev["Job ID"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            if "Submission Time" in info and "Completion Time" in info:
                stage_time[info["Stage ID"]] = info["Completion Time"] - info["Submission Time"]
        elif kind == "SparkListenerTaskEnd":
            ti = ev["Task Info"]
            task_times[ev["Stage ID"]].append(ti["Finish Time"] - ti["Launch Time"])
    per = defaultdict(lambda: {"jobs": set(), "stages": 0, "stage_ms": 0, "skew": 1.0,
                               "max_tasks": 0})
    for sid, ms in stage_time.items():
        d = per[job_desc.get(stage_job.get(sid), "-")]
        d["jobs"].add(stage_job.get(sid))
        d["stages"] += 1
        d["stage_ms"] += ms
        ts = task_times.get(sid, [])
        d["max_tasks"] = max(d["max_tasks"], len(ts))
        if len(ts) > 1 and statistics.median(ts) > 0:
            d["skew"] = max(d["skew"], max(ts) / statistics.median(ts))
    print(f"{'description':36s} {'jobs':>5s} {'stages':>6s} {'stage_ms':>9s} "
          f"{'max_tasks':>9s} {'skew':>6s}")
    for desc, d in sorted(per.items()):
        print(f"{desc:36s} {len(d['jobs']):5d} {d['stages']:6d} {d['stage_ms']:9d} "
              f"{d['max_tasks']:9d} {d['skew']:6.1f}")


if __name__ == "__main__":
    main(sys.argv[1])
