"""Summarise a Spark event log written by ``BENCH_EVENT_LOG_DIR=... bench.py``:
per query (job group) -- jobs, stages, summed task time, rows read from
files, shuffle rows and bytes written.  Timed passes only (warm-up excluded), averaged
per pass.  Usage: python scripts/stage_report.py <event-log-file>"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _open(path: str):
    if path.endswith(".zstd"):
        import zstandard

        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True),
                                encoding="utf-8")
    return open(path, encoding="utf-8")


def event_lines(path: str):
    """Lines of a single-file log or of a rolling (v2) log directory."""
    if os.path.isdir(path):
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        paths = [os.path.join(path, f) for f in files]
    else:
        paths = [path]
    for p in paths:
        with _open(p) as f:
            yield from f


def main(path: str) -> None:
    job_group, stage_job = {}, {}
    acc = defaultdict(lambda: defaultdict(float))
    if True:
        for line in event_lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
                if group:
                    acc[group]["jobs"] += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                group = job_group.get(stage_job.get(info["Stage ID"]), "")
                if not group:
                    continue
                acc[group]["stages"] += 1
                for a in info.get("Accumulables", []):
                    name, value = a.get("Name"), a.get("Value")
                    if name == "internal.metrics.executorRunTime":
                        acc[group]["task_ms"] += float(value)
                    elif name == "internal.metrics.input.recordsRead":
                        acc[group]["input_rows"] += float(value)
                    elif name == "internal.metrics.shuffle.write.recordsWritten":
                        acc[group]["shuffle_rows"] += float(value)
                    elif name == "internal.metrics.shuffle.write.bytesWritten":
                        acc[group]["shuffle_bytes"] += float(value)
    per_query = defaultdict(lambda: defaultdict(float))
    passes = defaultdict(int)
    for group, m in acc.items():
        name, sep, tag = group.partition(":")
        if not sep or tag == "warmup":
            continue
        passes[name] += 1
        for k, v in m.items():
            per_query[name][k] += v
    print(f"{'query':28s} {'jobs':>5s} {'stages':>6s} {'task_s':>7s} {'rows_in':>10s} "
          f"{'shuffle_rows':>12s} {'shuffle_MB':>10s} {'shuf/in':>8s}")
    for name, m in per_query.items():
        n = passes[name]
        rows_in, shuf_rows = m["input_rows"] / n, m["shuffle_rows"] / n
        ratio = f"{shuf_rows / rows_in:.4f}" if rows_in else "-"
        print(f"{name:28s} {m['jobs'] / n:5.0f} {m['stages'] / n:6.0f} {m['task_ms'] / n / 1000:7.2f} "
              f"{rows_in:10.0f} {shuf_rows:12.0f} {m['shuffle_bytes'] / n / 1e6:10.3f} {ratio:>8s}")


if __name__ == "__main__":
    main(sys.argv[1])
