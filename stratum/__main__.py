"""Command line: ``python -m stratum <stage> --base <root> ...``

Stages: ``ingest`` (one source or all, for a date), ``silver``, ``quality``
(gate; exit code 2 on a critical failure), ``gold``, ``run`` (all of them in
order, Gold only if the gate passes), ``stream`` (drain or run the event
ingest), ``report`` (report rows from the stored Gold marts as JSON lines).

Sources come from a JSON file: ``{"indicador": {"path": "...", "format":
"parquet", "options": {}}, "municipio": {...}, "meta_municipio": {...}}``.  A
source with ``"microdata": true`` holds single observations: the weighted
indicator is built from it while it is ingested.

Every stage that writes adds a record per job to the run metrics
(``<base>/metrics``) as the job ends.
"""

from __future__ import annotations

import argparse
import json
import sys

from stratum.plans.pipeline import Layout, run_checks, run_pipeline, run_silver
from stratum.session import get_session
from stratum.sources.registry import SourceRegistry


def load_registry(path: str) -> SourceRegistry:
    with open(path) as f:
        spec = json.load(f)
    reg = SourceRegistry()
    for key, src in spec.items():
        add = reg.add_microdata if src.get("microdata") else reg.add_path
        add(key, src["path"], src.get("format", "parquet"), **src.get("options", {}))
    return reg


def _print_rows(name: str, df) -> None:
    for row in df.collect():  # report outputs are small, bounded tables
        print(json.dumps({"report": name, **row.asDict()}, default=str))


def _done(metrics) -> None:
    for m in metrics:
        print(json.dumps(m.__dict__))


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="stratum")
    p.add_argument("stage", choices=["ingest", "silver", "quality", "gold", "run", "stream", "report"])
    p.add_argument("--base", required=True, help="root folder of the layers")
    p.add_argument("--sources", help="JSON file: logical key -> {path, format, options}")
    p.add_argument("--table", default="all", help="ingest: one logical key or 'all'")
    p.add_argument("--date", help="ingestion date YYYY-MM-DD (ingest, run)")
    p.add_argument("--landing", help="stream: folder of incoming JSON lines")
    p.add_argument("--schema", help="stream: fields of an event as DDL (default: any JSON object, fields as a VARIANT)")
    p.add_argument("--max-messages", type=int, help="stream: end a micro-batch at so many messages ...")
    p.add_argument("--max-seconds", type=float, default=60.0, help="... or so long after its first one")
    p.add_argument("--input-bytes", type=int, help="size shuffles for this much input ...")
    p.add_argument("--cores", type=int, help="... on this many cores")
    p.add_argument("--seconds", type=float, help="stream: run continuously this long (default: drain and stop)")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    a = p.parse_args(argv)

    from stratum.operators.quality import QualityGateError, run_gate

    spark = spark or get_session(a.master, input_bytes=a.input_bytes, total_cores=a.cores)
    layout = Layout(a.base.rstrip("/"))
    if a.stage in ("ingest", "run") and not (a.sources and a.date):
        p.error("--sources and --date are required for this stage")

    if a.stage == "ingest":
        from stratum.plans.ingest import ingest
        _done(ingest(spark, load_registry(a.sources), a.table, layout.bronze, a.date, metrics=layout.metrics))
    elif a.stage == "silver":
        _done([run_silver(spark, layout)])
    elif a.stage == "quality":
        try:
            run_gate(run_checks(spark, layout))
        except QualityGateError:
            return 2
    elif a.stage == "gold":
        from stratum.plans.gold import build_gold
        _done(build_gold(spark, layout.silver, layout.gold, metrics=layout.metrics))
    elif a.stage == "run":
        res = run_pipeline(spark, load_registry(a.sources), layout.base, a.date, raise_on_gate=False)
        _done(res.metrics)
        return 0 if res.gate_passed else 2
    elif a.stage == "stream":
        if not a.landing:
            p.error("--landing is required for stream")
        from pyspark.sql import types as T

        from stratum.plans.pipeline import run_stream
        from stratum.streaming.events import StreamConfig
        cfg = StreamConfig(landing=a.landing, bronze=f"{layout.bronze}/eventos",
                           quarantine=f"{layout.bronze}/eventos_quarentena",
                           checkpoint=f"{layout.base}/_checkpoints/eventos",
                           schema=T.StructType.fromDDL(a.schema) if a.schema else None,
                           max_messages=a.max_messages, max_seconds=a.max_seconds)
        print(json.dumps(run_stream(spark, layout, cfg, a.seconds).__dict__))
    elif a.stage == "report":
        # like the reference's dashboard: everything from the stored Gold marts
        from stratum.operators import reporting as rp
        from stratum.plans.gold import read_marts
        from stratum.spec import DEFAULT_SPEC as S
        gold = read_marts(spark, layout.gold)
        ind = gold["gold_indicador_por_municipio"]
        goal_vs = gold["gold_meta_vs_resultado"]
        evolution = gold["gold_evolucao_temporal_uf"]
        _print_rows("kpis", rp.kpi_summary_from_marts(ind, goal_vs))
        _print_rows("regions_latest", rp.region_vs_mean(evolution))
        _print_rows("national_evolution", rp.national_evolution(evolution))
        _print_rows("distribution", rp.histogram(spark, ind, S.rate, S.period))
        _print_rows("worst_gaps", rp.worst_gap_topk(goal_vs))
    return 0


if __name__ == "__main__":
    sys.exit(main())
