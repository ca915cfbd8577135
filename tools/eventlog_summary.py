"""Summarize a Spark event log: jobs, stages and tasks per call site.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/eventlog_summary.py <that folder>

Reads plain or zstd-compressed (Spark 4 default) rolling event logs.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _events(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) or [path]
    for f in files:
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def shuffle_bytes(path: str, begin_ms: float, end_ms: float) -> int:
    """Shuffle bytes written by the tasks launched in a span of time."""
    total = 0
    for e in _events(path):
        if e["Event"] == "SparkListenerTaskEnd" and begin_ms <= e["Task Info"]["Launch Time"] <= end_ms:
            total += (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return total


def summarize(path: str) -> dict:
    jobs, stages, tasks = {}, {}, defaultdict(int)
    for e in _events(path):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            site = (e.get("Properties") or {}).get("callSite.short", "") or "?"
            jobs[e["Job ID"]] = {"site": site, "start": e["Submission Time"], "end": None}
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = info.get("Completion Time", 0) - info.get("Submission Time", 0)
        elif kind == "SparkListenerTaskEnd":
            tasks[e["Stage ID"]] += 1
    by_site = defaultdict(lambda: [0, 0])
    for j in jobs.values():
        by_site[j["site"]][0] += 1
        by_site[j["site"]][1] += (j["end"] or j["start"]) - j["start"]
    span = max((j["end"] or 0) for j in jobs.values()) - min(j["start"] for j in jobs.values()) if jobs else 0
    return {
        "jobs": len(jobs),
        "stages": len(stages),
        "tasks": sum(tasks.values()),
        "span_ms": span,
        "job_ms_by_site": sorted(((v[1], v[0], k) for k, v in by_site.items()), reverse=True),
    }


if __name__ == "__main__":
    out = summarize(sys.argv[1])
    print(f"jobs {out['jobs']}  stages {out['stages']}  tasks {out['tasks']}  span {out['span_ms']} ms")
    for ms, n, site in out["job_ms_by_site"][:25]:
        print(f"{ms:8d} ms  {n:4d} jobs  {site}")
