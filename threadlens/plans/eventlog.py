"""Summarize a Spark event log: the slowest stages with their task counts,
shuffle volumes and spill (no UI or REST server involved).

    python -m threadlens.plans.eventlog <event-log-dir-or-file> [top]
"""

from __future__ import annotations

import json
import os
import sys


def stages(path: str) -> list[dict]:
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
             if f.startswith("events_") or f.startswith("local-") or f.startswith("app-")] \
        if os.path.isdir(path) else [path]
    out = []
    for fn in sorted(files):
        opener = open
        if fn.endswith(".zstd"):
            import zstandard
            opener = lambda f: __import__("io").TextIOWrapper(
                zstandard.ZstdDecompressor().stream_reader(open(f, "rb")))
        with opener(fn) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                out.append({
                    "stage": info["Stage ID"], "name": info["Stage Name"][:60],
                    "tasks": info["Number of Tasks"],
                    "ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
                    "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                    "shuffle_read": acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                    "spill": acc.get("internal.metrics.diskBytesSpilled", 0),
                })
    return out


def main(path: str, top: int = 15) -> None:
    rows = sorted(stages(path), key=lambda r: -r["ms"])
    print(f"{'stage':>5} {'ms':>7} {'tasks':>5} {'shuf_w':>9} {'shuf_r':>9} {'spill':>7}  name")
    for r in rows[:top]:
        print(f"{r['stage']:>5} {r['ms']:>7} {r['tasks']:>5} {r['shuffle_write']:>9} {r['shuffle_read']:>9} "
              f"{r['spill']:>7}  {r['name']}")
    print(f"stages: {len(rows)}, total stage ms: {sum(r['ms'] for r in rows)}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
