"""Summarise a Spark event log by job group: jobs, stages, tasks, busy time.

    python tools/stage_times.py <event-log-file-or-folder>

Use with ``BENCH_EVENT_LOG=<folder> python bench.py``; each timed query runs
in a job group named after it (streaming queries run under their own run id).
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _log_file(path: str) -> str:
    if os.path.isfile(path):
        return path
    files = [os.path.join(path, f) for f in os.listdir(path) if not f.startswith(".")]
    files = [f for f in files if os.path.isfile(f)]
    return max(files, key=os.path.getmtime)


def main() -> None:
    path = _log_file(sys.argv[1])
    job_group, job_span, stage_job = {}, {}, {}
    stats = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "task_ms": 0, "wall_ms": 0})
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev["Event"]
            if kind == "SparkListenerJobStart":
                group = ev.get("Properties", {}).get("spark.jobGroup.id") or "(none)"
                job_group[ev["Job ID"]] = group
                job_span[ev["Job ID"]] = ev["Submission Time"]
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
                stats[group]["jobs"] += 1
            elif kind == "SparkListenerJobEnd":
                group = job_group.get(ev["Job ID"], "(none)")
                stats[group]["wall_ms"] += ev["Completion Time"] - job_span.get(ev["Job ID"], 0)
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                group = job_group.get(stage_job.get(info["Stage ID"]), "(none)")
                stats[group]["stages"] += 1
                stats[group]["tasks"] += info.get("Number of Tasks", 0)
            elif kind == "SparkListenerTaskEnd":
                group = job_group.get(stage_job.get(ev["Stage ID"]), "(none)")
                info = ev["Task Info"]
                stats[group]["task_ms"] += info["Finish Time"] - info["Launch Time"]
    print(f"{'group':24s} {'jobs':>5s} {'stages':>7s} {'tasks':>6s} {'job ms':>8s} {'task ms':>8s}")
    for group, st in sorted(stats.items(), key=lambda kv: -kv[1]["wall_ms"]):
        print(f"{group:24s} {st['jobs']:5d} {st['stages']:7d} {st['tasks']:6d} "
              f"{st['wall_ms']:8d} {st['task_ms']:8d}")


if __name__ == "__main__":
    try:
        main()
    except BrokenPipeError:  # output piped into head
        pass
