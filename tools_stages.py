"""Stage times from a Spark event log (no UI needed).

    python tools_stages.py <event log file or folder> [top_n]

Prints the slowest stages with their task count, shuffle read/write and the
SQL description of the job they belong to.
"""
from __future__ import annotations

import json
import os
import sys


def _files(path: str) -> list[str]:
    """Event log files under ``path`` (plain or rolled ``eventlog_v2_*`` folders)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, files in os.walk(path):
        out += [os.path.join(root, f) for f in files if f.startswith(("events", "local-", "app-"))
                and not f.endswith(".inprogress.tmp")]
    return sorted(out)


def _open(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
    return open(f, encoding="utf-8")


def main(argv: list[str]) -> None:
    path, top = argv[1], int(argv[2]) if len(argv) > 2 else 20
    stages, job_desc, stage_job = {}, {}, {}
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description") or ""
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = e["Job ID"]
                    job_desc[e["Job ID"]] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    stages[info["Stage ID"]] = {
                        "ms": (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0),
                        "tasks": info.get("Number of Tasks"), "name": info.get("Stage Name", "")[:60],
                        "shuffle_read": acc.get("internal.metrics.shuffle.read.recordsRead"),
                        "shuffle_write": acc.get("internal.metrics.shuffle.write.recordsWritten"),
                    }
    rows = sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]
    for sid, s in rows:
        desc = job_desc.get(stage_job.get(sid), "")[:50]
        print(f"stage {sid:5d} {s['ms']:7d} ms tasks {s['tasks']:4d} "
              f"shuffle r/w {s['shuffle_read']}/{s['shuffle_write']}  {s['name']}  {desc}")


if __name__ == "__main__":
    main(sys.argv)
