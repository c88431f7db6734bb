"""Summarise a Spark event log written by ``bench.py`` (BENCH_EVENT_LOG_DIR):
per check and run, the jobs, stages, tasks, shuffle bytes written and read,
and spilled bytes. Writes STAGES.md (warm runs only)."""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def event_lines(event_dir: str):
    """Lines of the newest application log (single file or rolling folder)."""
    apps = sorted(glob.glob(os.path.join(event_dir, "*")), key=os.path.getmtime)
    if not apps:
        raise SystemExit("no event log found")
    app = apps[-1]
    files = (sorted(glob.glob(os.path.join(app, "events_*")),
                    key=lambda f: int(os.path.basename(f).split("_")[1]))
             if os.path.isdir(app) else [app])
    for f in files:
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(f) as fh:
                yield from fh


def main(event_dir: str, run: str = "1") -> None:
    stage_group, rows = {}, defaultdict(lambda: defaultdict(int))
    for line in event_lines(event_dir):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            if group:
                rows[group]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
        elif kind == "SparkListenerStageSubmitted":
            group = stage_group.get(ev["Stage Info"]["Stage ID"])
            if group:
                rows[group]["stages"] += 1
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(ev.get("Stage ID"))
            tm = ev.get("Task Metrics") or {}
            if not group or not tm:
                continue
            r = rows[group]
            r["tasks"] += 1
            r["input"] += (tm.get("Input Metrics") or {}).get("Records Read", 0)
            r["shuffle_write"] += (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            rd = tm.get("Shuffle Read Metrics") or {}
            r["shuffle_read"] += rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
            r["spill"] += tm.get("Disk Bytes Spilled", 0)
            r["run_ms"] += tm.get("Executor Run Time", 0)
    out = ["# Stage metrics per check (warm run, from the Spark event log)\n",
           "Generated by `scripts/stage_report.py` from a `bench.py` run with `BENCH_EVENT_LOG_DIR` set. "
           "Values are sums of Spark's task metrics over the check's warm run (setup writes included).\n",
           "| check | jobs | stages | tasks | task time ms | input records | shuffle write bytes | shuffle read bytes | spill bytes |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for group in sorted(g for g in rows if g.endswith(f"#{run}")):
        r = rows[group]
        out.append(f"| `{group.rsplit('#', 1)[0]}` | {r['jobs']} | {r['stages']} | {r['tasks']} | "
                   f"{r['run_ms']:,} | {r['input']:,} | {r['shuffle_write']:,} | {r['shuffle_read']:,} | "
                   f"{r['spill']:,} |")
    with open(os.path.join(ROOT, "STAGES.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main(sys.argv[1])
