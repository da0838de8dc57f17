"""The batch pipeline in its fixed order on one session:
ingest every source -> Silver (written) -> quality gate -> Gold.

The gate runs after the Silver write and before Gold: a critical failure
leaves the new Silver in place but does not rebuild Gold.  Silver and Gold are
published by version: while one is rebuilt, or after a build that died, readers
have the version before.  Each job's metric is
stored as the job ends, so a later failure loses none.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from stratum.operators.quality import CheckResult, QualityGateError, run_gate, table_checks
from stratum.plans.gold import build_gold
from stratum.plans.ingest import ingest
from stratum.plans.silver import build_silver
from stratum.sources.bronze import read_bronze
from stratum.sources.layers import by_partition, read_silver, silver_partitions, write_silver
from stratum.sources.metrics import RunMetric, append_metrics, observed_write, timed
from stratum.sources.registry import SourceRegistry
from stratum.spec import DEFAULT_SPEC, IndicatorSpec
from stratum.streaming.events import DrainResult, StreamConfig, drain, run_for

# Logical keys of the three sources Silver is built from.
FACT, DIMENSION, GOALS = "indicador", "municipio", "meta_municipio"
# Run-metric job names -- "ingest_batch_<key>", "transform_silver",
# "build_<mart>", "ingest_streaming" -- and layers "bronze", "silver", "gold".
SILVER_JOB = "transform_silver"
STREAM_JOB = "ingest_streaming"


@dataclass
class Layout:
    """Where each layer lives (all under one shared base)."""
    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/indicador"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold"

    @property
    def metrics(self) -> str:
        return f"{self.base}/metrics"

    @property
    def batch_metrics(self) -> str:
        return f"{self.base}/metrics_stream"


@dataclass
class PipelineResult:
    layout: Layout
    metrics: list[RunMetric] = field(default_factory=list)
    checks: list[CheckResult] = field(default_factory=list)
    gate_passed: bool = False
    gold_written: bool = False
    failed_checks: list[str] = field(default_factory=list)


def run_silver(spark: SparkSession, layout: Layout, spec: IndicatorSpec = DEFAULT_SPEC) -> RunMetric:
    """Latest snapshot of each source -> Silver, counted during the write
    (after the shuffle that deals rows to the partitions' tasks)."""
    silver = build_silver(read_bronze(spark, layout.bronze, FACT, spec=spec),
                          read_bronze(spark, layout.bronze, DIMENSION, spec=spec),
                          read_bronze(spark, layout.bronze, GOALS, spec=spec), spec)
    metric = observed_write(by_partition(silver, silver_partitions(spec)),
                            lambda d: write_silver(d, layout.silver, spec, dealt=True), job=SILVER_JOB, layer="silver")
    append_metrics(spark, [metric], layout.metrics)
    return metric


def run_stream(spark: SparkSession, layout: Layout, cfg: StreamConfig, seconds: float | None = None) -> DrainResult:
    """Drain the event stream, or run it for some seconds, and store its record;
    those of its micro-batches are stored while it runs."""
    began = time.perf_counter()
    cfg = replace(cfg, batch_metrics=cfg.batch_metrics or layout.batch_metrics)
    result = drain(spark, cfg) if seconds is None else run_for(spark, cfg, seconds)
    append_metrics(spark, [timed(STREAM_JOB, "bronze", result.rows_in, began)], layout.metrics)
    return result


def run_checks(spark: SparkSession, layout: Layout, spec: IndicatorSpec = DEFAULT_SPEC):
    """Checks on the written Silver; the parent for the orphan check is the
    dimension across all ingestion dates, as ingested."""
    s = spec
    return table_checks(
        read_silver(spark, layout.silver, s),
        read_bronze(spark, layout.bronze, DIMENSION, latest=False, spec=s),
        keys=s.keys_of("silver"), missing_cols=list(s.metrics), range_col=s.rate,
        orphan_keys_cols=s.keys_of("municipio"), missing_limit=s.missing_limit_pct,
        low=s.range_low, high=s.range_high, tolerance=s.range_tolerance)


def run_pipeline(spark: SparkSession, registry: SourceRegistry, base: str, ingest_date: str,
                 spec: IndicatorSpec = DEFAULT_SPEC, *, raise_on_gate: bool = True,
                 report=print) -> PipelineResult:
    layout = Layout(base.rstrip("/"))
    result = PipelineResult(layout)
    result.metrics += ingest(spark, registry, "all", layout.bronze, ingest_date, spec=spec, metrics=layout.metrics)
    result.metrics.append(run_silver(spark, layout, spec))
    try:
        result.checks = run_gate(run_checks(spark, layout, spec), report=report)
        result.gate_passed = True
    except QualityGateError as err:
        result.checks = err.results
        result.failed_checks = [r.name for r in err.failed]
        if raise_on_gate:
            raise
        return result
    result.metrics += build_gold(spark, layout.silver, layout.gold, spec, metrics=layout.metrics)
    result.gold_written = True
    return result
