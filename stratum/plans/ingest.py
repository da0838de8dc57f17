"""Bronze batch ingest: read each selected source whole, add audit columns and
write it as the partition of the ingestion date."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from stratum.operators.bronze import EmptySourceError
from stratum.sources.bronze import write_snapshot
from stratum.sources.metrics import RunMetric, append_metrics, observed_write
from stratum.sources.registry import SourceRegistry
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

BATCH_SOURCE = "batch"


def ingest_table(spark: SparkSession, registry: SourceRegistry, key: str, base: str,
                 ingest_date: str, *, source: str = BATCH_SOURCE,
                 spec: IndicatorSpec = DEFAULT_SPEC, metrics: str | None = None) -> RunMetric:
    """One pass: the rows are counted while they are written.  With
    ``metrics``, the job's record is stored there as it ends.

    An empty source writes no partition (dynamic overwrite only replaces
    partitions present in the data) and then raises, so nothing of it lands.
    """
    df = registry.read(spark, key)
    metric = observed_write(df, lambda d: write_snapshot(d, base, key, ingest_date, source, spec),
                            job=f"ingest_batch_{key}", layer="bronze")
    if metric.rows_processed == 0:
        raise EmptySourceError(f"table '{key}' is empty; nothing ingested")
    if metrics:
        append_metrics(spark, [metric], metrics)
    return metric


def ingest(spark: SparkSession, registry: SourceRegistry, which: str, base: str,
           ingest_date: str, *, parallel: bool = True, **kw) -> list[RunMetric]:
    """``which`` is one logical key or ``"all"``; the date is a parameter.

    The sources are independent, so their jobs are submitted concurrently
    from driver threads (Spark schedules them side by side): a small table
    does not wait behind a large one.  Every source is attempted; the first
    failure is raised after all have finished.
    """
    keys = registry.select(which)
    run = lambda k: ingest_table(spark, registry, k, base, ingest_date, **kw)
    if not parallel or len(keys) == 1:
        return [run(k) for k in keys]
    with ThreadPoolExecutor(max_workers=len(keys)) as pool:
        futures = [pool.submit(run, k) for k in keys]
    return [f.result() for f in futures]
