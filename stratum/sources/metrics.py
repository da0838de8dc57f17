"""Run metrics: one record per job (job, layer, rows, seconds, timestamp).

The row count rides on the job's own write through an ``Observation`` -- the
plan runs once, instead of a ``count()`` followed by the write.
"""

from __future__ import annotations

import io
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratum.sources.files import write_file

METRIC_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])


@dataclass
class RunMetric:
    job: str
    layer: str
    rows_processed: int
    duration_seconds: float
    timestamp: str

    def as_row(self) -> tuple:
        return (self.job, self.layer, self.rows_processed, self.duration_seconds, self.timestamp)


def observed_write(df: DataFrame, write: Callable[[DataFrame], object], job: str,
                   layer: str) -> RunMetric:
    """Run ``write(df)`` and count its rows in the same pass.  ``write`` adds
    no shuffle: rows are counted in the tasks that write them, once each (of
    a task that runs again only the last attempt counts)."""
    start = time.perf_counter()
    obs = Observation(f"{job}_metrics")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return timed(job, layer, int(obs.get.get("rows", 0) or 0), start)


def metrics_frame(spark: SparkSession, metrics: list[RunMetric]) -> DataFrame:
    """The run's metric records as a DataFrame (a handful of driver-side
    bookkeeping rows, not data)."""
    return spark.createDataFrame([m.as_row() for m in metrics], METRIC_SCHEMA)


def timed(job: str, layer: str, rows: int, start: float) -> RunMetric:
    """The metric of a job that began at ``start`` (``time.perf_counter``)."""
    return RunMetric(job, layer, rows, round(time.perf_counter() - start, 2), datetime.now(timezone.utc).isoformat())


BATCH_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])


@dataclass
class BatchMetric:
    """One micro-batch of a stream; ``query_id`` stays with the checkpoint."""
    query_id: str
    batch_id: int
    rows_processed: int
    duration_seconds: float
    timestamp: str

    def as_row(self) -> tuple:
        return (self.query_id, self.batch_id, self.rows_processed, self.duration_seconds, self.timestamp)


def _append(spark: SparkSession, rows: list[tuple], schema: T.StructType, path: str) -> str:
    """One more file of a records table: a few records go straight to the file
    system, without a Spark job, and writers side by side don't wait for each
    other."""
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    out = io.BytesIO()
    pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), out, compression="snappy")
    write_file(spark, f"{path.rstrip('/')}/part-{uuid.uuid4().hex}.snappy.parquet", out.getvalue())
    return path


def append_metrics(spark: SparkSession, metrics: list[RunMetric], path: str) -> str:
    return _append(spark, [m.as_row() for m in metrics], METRIC_SCHEMA, path)


def append_batch_metrics(spark: SparkSession, metrics: list[BatchMetric], path: str) -> str:
    return _append(spark, [m.as_row() for m in metrics], BATCH_SCHEMA, path)
