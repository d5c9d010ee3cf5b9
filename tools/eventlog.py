"""Summarise a Spark event log: per SQL execution, the scans in its plan;
per stage, its task count and wall time.

Usage: python tools/eventlog.py <event log dir or file>

Enable the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<scratch folder>``.  Rolled and zstd-compressed logs
are read too.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _open(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as raw:
            data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        return io.StringIO(data.decode("utf-8"))
    return open(path, encoding="utf-8")


def events(path: str):
    files = []
    if os.path.isdir(path):
        for root, _, names in os.walk(path):
            files += [os.path.join(root, n) for n in sorted(names) if not n.startswith(("appstatus", "."))]
    else:
        files = [path]
    for f in files:
        with _open(f) as fh:
            for line in fh:
                if line.strip():
                    yield json.loads(line)


def main() -> None:
    stages = {}
    for e in events(sys.argv[1]):
        kind = e.get("Event", "")
        if kind.endswith("SparkListenerSQLExecutionStart"):
            # the node tree only (the formatted plan repeats every node below it)
            plan = e.get("physicalPlanDescription", "").split("\n\n")[0]
            print(f"sql {e['executionId']:>3}: text scans={plan.count('Scan text')} "
                  f"parquet scans={plan.count('Scan parquet')} exchanges={plan.count('Exchange')} "
                  f"| {e.get('description', '')[:50]}")
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            took = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages[info["Stage ID"]] = (info["Number of Tasks"], took, info["Stage Name"][:60])
    for sid, (tasks, took, name) in sorted(stages.items()):
        print(f"stage {sid:>4}: tasks={tasks:>4} {took:7.2f}s {name}")


if __name__ == "__main__":
    main()
