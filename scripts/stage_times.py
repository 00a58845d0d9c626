"""Summarise a Spark event log: jobs, stages and where the time goes.

Usage: python scripts/stage_times.py <event-log-file-or-folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys
from collections import Counter


def _open(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def events(path: str):
    """Events of a plain log file or of a folder of (rolling) logs."""
    if os.path.isfile(path):
        files = [path]
    else:
        files = sorted(
            os.path.join(root, f) for root, _, names in os.walk(path) for f in names if not f.startswith(("appstatus", "."))
        )
    for f in files:
        with _open(f) as fh:
            for line in fh:
                if line.startswith("{"):
                    yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], 0
    by_name: Counter = Counter()
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs += 1
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            ms = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
            name = info.get("Stage Name", "?").split(" at ")[0]
            stages.append((ms, info.get("Number of Tasks", 0), name))
            by_name[name] += ms
    total = sum(ms for ms, _, _ in stages)
    print(f"jobs {jobs}, stages {len(stages)}, stage time {total / 1000:.2f} s")
    for name, ms in by_name.most_common(top):
        print(f"{ms / 1000:8.2f} s  {name}")


if __name__ == "__main__":
    main()
