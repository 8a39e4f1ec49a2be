"""Summarise a Spark event log: per job, its stages with task count, wall time and the
slowest task (to spot skew).

    python scripts/stage_times.py <event-log-file> [--top 20]
"""

from __future__ import annotations

import argparse
import json
import os
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a file, or a rolling-log folder (events_* files in order)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fn in files:
        if fn.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import io

            import zstandard
            with open(fn, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fn) as f:
                yield from f


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("log")
    ap.add_argument("--top", type=int, default=20)
    a = ap.parse_args()
    stages, tasks = {}, defaultdict(list)
    for line in _lines(a.log):
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            stages[info["Stage ID"]] = (info["Stage Name"][:60], info["Number of Tasks"], dur)
        elif kind == "SparkListenerTaskEnd":
            t = e["Task Info"]
            tasks[e["Stage ID"]].append(t["Finish Time"] - t["Launch Time"])
    rows = sorted(stages.items(), key=lambda kv: -kv[1][2])[:a.top]
    print(f"{'stage':>6} {'tasks':>6} {'wall ms':>8} {'max task':>9} {'median':>7}  name")
    for sid, (name, n, dur) in rows:
        ts = sorted(tasks.get(sid, [0]))
        print(f"{sid:>6} {n:>6} {dur:>8} {ts[-1]:>9} {ts[len(ts) // 2]:>7}  {name}")


if __name__ == "__main__":
    main()
