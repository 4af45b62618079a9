"""Stage timings from a Spark event log folder (no UI or REST needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing at a scratch folder, then:

    python tools/stage_times.py <event log dir>

prints one line per completed stage: job, stage, name, tasks, wall ms.
Handles plain and zstd-compressed (rolling) logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd") or path.endswith(".zst"):
            import zstandard

            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main(root: str) -> None:
    files = sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)) or sorted(
        f for f in glob.glob(os.path.join(root, "*")) if os.path.isfile(f)
    )
    stage_job: dict[int, int] = {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
                print(f"job {stage_job.get(si['Stage ID'], '?'):>4} stage {si['Stage ID']:>4} "
                      f"tasks {si['Number of Tasks']:>5} {ms:>7} ms  {si['Stage Name'][:60]}")


if __name__ == "__main__":
    main(sys.argv[1])
