"""Summarise a Spark event log: jobs per job group and the slowest stages.

    BENCH_EVENT_LOG=1 python bench.py          # prints the event-log folder on stderr
    python tools/event_log_stages.py <folder or file> [top_n]

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled`` (no UI, no server).
"""

from __future__ import annotations

import collections
import json
import os
import sys


def _files(path: str) -> list[str]:
    """Event files under ``path`` (Spark 4 writes a folder per application, rolled files)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        for name in sorted(names):
            if not name.startswith((".", "appstatus")):
                out.append(os.path.join(root, name))
    return out


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def main(argv: list[str]) -> None:
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stage_names: dict[tuple[int, int], str] = {}
    stage_secs: dict[tuple[int, int], float] = {}
    job_group: dict[int, str] = {}
    jobs_per_group: collections.Counter[str] = collections.Counter()
    for f in _files(path):
        for line in _lines(f):
            if not line.strip():
                continue
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                group = props.get("spark.jobGroup.id") or "(none)"
                job_group[ev["Job ID"]] = group
                jobs_per_group[group] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                key = (info["Stage ID"], info.get("Stage Attempt ID", 0))
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stage_secs[key] = (end - start) / 1000.0
                    stage_names[key] = info.get("Stage Name", "")
    print(f"jobs: {sum(jobs_per_group.values())}, stages: {len(stage_secs)}, "
          f"stage seconds: {sum(stage_secs.values()):.1f}")
    print("\njobs per job group (pipeline steps are named <run_id>:<task>):")
    for group, n in jobs_per_group.most_common():
        print(f"  {n:5d}  {group}")
    print(f"\nslowest {top} stages:")
    for key, secs in sorted(stage_secs.items(), key=lambda kv: -kv[1])[:top]:
        print(f"  {secs:7.2f}s  stage {key[0]}.{key[1]}  {stage_names[key][:90]}")


if __name__ == "__main__":
    main(sys.argv)
