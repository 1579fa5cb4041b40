"""Summarise a Spark event log (spark.eventLog.dir): per job, its wall time,
stages, tasks and shuffle bytes. Usage: python tools/stage_times.py LOG (file or rolling-log folder)"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log file, or of every part of a rolling log folder."""
    import os

    files = ([os.path.join(path, n) for n in sorted(os.listdir(path)) if n.startswith("events_")]
             if os.path.isdir(path) else [path])
    for name in files:
        if name.endswith(".zstd"):
            import io

            import zstandard

            with open(name, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(name) as f:
                yield from f


def main(path: str) -> None:
    jobs, stage_job, stages = {}, {}, defaultdict(dict)
    for line in _lines(path):
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"],
                                 "desc": (e.get("Properties") or {}).get(
                                     "spark.job.description", "")[:60]}
            for sid in e["Stage IDs"]:
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            st = stages[info["Stage ID"]]
            st["tasks"] = info["Number of Tasks"]
            st["ms"] = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            for acc in info.get("Accumulables", []):
                if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                    st["shuffle_write"] = int(acc.get("Value", 0))
    for jid, j in sorted(jobs.items()):
        run = [s for s in j["stages"] if s in stages]
        print(f"job {jid:4d} {j.get('end', j['start']) - j['start']:6d} ms  stages={len(run)} "
              f"tasks={sum(stages[s].get('tasks', 0) for s in run)} "
              f"shuffle_write={sum(stages[s].get('shuffle_write', 0) for s in run)}  {j['desc']}")


if __name__ == "__main__":
    main(sys.argv[1])
