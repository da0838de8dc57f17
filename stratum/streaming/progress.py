"""A stored record for each micro-batch, written while the stream runs.

A run that is killed, or one that never ends, leaves the records of the
micro-batches that were committed; the run's own record comes only at its end.
A trigger that writes several micro-batches leaves a record of each, its time
shared among them.  Where such a trigger ends early, the micro-batches that it
wrote are recorded as well; written again, they have their record already.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from stratum.sources.files import names
from stratum.sources.metrics import BATCH_SCHEMA, BatchMetric, append_batch_metrics

#: By trigger: the rows of each micro-batch that it wrote, and its seconds.
Parts = dict[int, tuple[dict[int, int], float]]


class BatchRecords(StreamingQueryListener):
    """Appends to the table at ``path``, for queries whose name is ``query``."""

    def __init__(self, spark: SparkSession, path: str, query: str):
        self.spark, self.path, self.query = spark, path, query
        self.ids: set[str] = set()
        self.parts: Parts = {}
        self.first = True
        self.ended = threading.Event()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.ids.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) not in self.ids or p.numInputRows == 0:  # a trigger without data runs no batch
            return
        sizes, _ = self.parts.pop(p.batchId, ({p.batchId: p.numInputRows}, 0.0))
        self._record(str(p.id), sizes, p.durationMs.get("triggerExecution", 0) / 1000, p.timestamp)

    def _record(self, query_id: str, sizes: dict[int, int], seconds: float, timestamp: str) -> None:
        try:
            if self.first:  # only a run's first trigger can be one written before
                self.first, known = False, self._recorded(query_id, min(sizes), max(sizes))
            else:
                known = set()
            each = seconds / len(sizes)
            new = [BatchMetric(query_id, k, n, each, timestamp) for k, n in sizes.items() if k not in known]
            if new:
                append_batch_metrics(self.spark, new, self.path)
        except Exception as err:  # noqa: BLE001 - shown to the caller when the run ends
            self.failure = err

    def _recorded(self, query_id: str, low: int, high: int) -> set[int]:
        if not names(self.spark, self.path):
            return set()
        rows = self.spark.read.schema(BATCH_SCHEMA).parquet(self.path).where(
            (F.col("query_id") == query_id) & F.col("batch_id").between(low, high))
        return {r.batch_id for r in rows.select("batch_id").collect()}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.ids:
            while self.parts:  # triggers that ended without being committed
                sizes, seconds = self.parts.popitem()[1]
                self._record(str(event.id), sizes, seconds, datetime.now(timezone.utc).isoformat())
            self.ids.discard(str(event.runId))
            if not self.ids:
                self.ended.set()


@contextmanager
def batch_records(spark: SparkSession, path: str | None, query: str, wait_s: float = 20.0) -> Iterator[Parts | None]:
    """While the block runs, micro-batches of queries named ``query`` are
    recorded; at its end, what the listener still has to hear is waited for.
    The block is given where to note the micro-batches of each trigger.
    Without a path nothing is recorded."""
    if path is None:
        yield None
        return
    listener = BatchRecords(spark, path, query)
    spark.streams.addListener(listener)
    try:
        yield listener.parts
    finally:
        listener.ended.wait(wait_s)
        spark.streams.removeListener(listener)
    if listener.failure is not None:
        raise listener.failure
