"""bench.py keeps its contract: one JSON line on stdout with metric, value,
unit, queries and sf."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="bronze_weighted_indicator,kpi_coverage", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= doc.keys()
    assert doc["unit"] == "sec" and doc["sf"] == "0.001"
    assert set(doc["queries"]) == {"bronze_weighted_indicator", "kpi_coverage"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 1e-6
