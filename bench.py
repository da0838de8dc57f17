"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is fully executed with the ``noop`` sink (all rows produced, none
collected).  One warm-up pass, then ``$BENCH_REPEATS`` timed passes over all
queries in turn; the median per query is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratum.plans import queries as Q  # noqa: E402
from stratum.session import get_session  # noqa: E402

SILVER = "silver_stored_build"  # what the reports and checks below read, built and written
HEADLINE = [
    SILVER,
    "bronze_weighted_indicator",
    "silver_goals_long",
    "silver_integrated",
    "gold_goal_vs_result",
    "gold_region_evolution",
    "dq_duplicates",
    "dq_report",
    "kpi_summary",
    "kpi_region_vs_mean",
    "kpi_distribution",
    "kpi_worst_gap_topk",
    "silver_partition_roundtrip",
    "stream_ingest_bronze",
    "run_metrics",  # end to end: ingest, Silver, gate, Gold, stream drain
]


def run_once(spark, name: str, sf_dir: str, tag: str = "") -> float:
    spark.sparkContext.setJobGroup(f"{name}{tag}", name)
    t0 = time.perf_counter()
    if name == SILVER:
        Q.store_silver(spark, sf_dir)
        return time.perf_counter() - t0
    Q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    }
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # per-stage times and shuffle bytes: scripts/stage_report.py
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_session(f"local[{cpus}]", app="stratum-bench", conf=conf)
    errors = {}
    for name in names:
        try:
            run_once(spark, name, sf_dir, ":warmup")
        except Exception as exc:  # noqa: BLE001 - report and keep benchmarking the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    # round-robin passes, so a drift in machine speed touches every query alike
    samples: dict[str, list[float]] = {n: [] for n in names if n not in errors}
    for i in range(repeats):
        for name in samples:
            samples[name].append(run_once(spark, name, sf_dir, f":{i}"))
    per_query = {name: round(statistics.median(ts), 3) for name, ts in samples.items()}
    spark.stop()
    sf = Path(sf_dir).name.removeprefix("sf")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(per_query.values()), 3),
           "unit": "sec", "queries": per_query, "sf": sf, "cpus": int(cpus), "repeats": repeats}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
