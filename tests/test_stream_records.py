"""Records of micro-batches: of a run that dies, of one that goes on, of none."""

import json
from dataclasses import replace

import pytest

from stratum.plans.pipeline import Layout, run_stream
from stratum.session import scratch_path
from stratum.streaming.events import StreamConfig, drain


@pytest.fixture()
def cfg(spark):
    base = scratch_path(spark, "records")
    rows = [(json.dumps({"event_id": i}),) for i in range(8)] + [("broken",)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{base}/landing/one")
    return StreamConfig(landing=f"{base}/landing", bronze=f"{base}/bronze", quarantine=f"{base}/quarantine",
                        checkpoint=f"{base}/checkpoint", max_messages=4, batch_metrics=f"{base}/batches")


def records(spark, cfg):
    return sorted((r.batch_id, r.rows_processed) for r in spark.read.parquet(cfg.batch_metrics).collect())


def test_a_run_killed_after_two_batches_leaves_two_records(spark, cfg):
    def die(batch_id):
        if batch_id == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain(spark, replace(cfg, on_batch=die))
    assert records(spark, cfg) == [(0, 4), (1, 4)]
    drain(spark, cfg)
    assert records(spark, cfg) == [(0, 4), (1, 4), (2, 1)]
    found = spark.read.parquet(cfg.batch_metrics).collect()
    assert len({r.query_id for r in found}) == 1 and all(r.duration_seconds > 0 and r.timestamp for r in found)


def test_the_pipeline_stores_batches_beside_runs(spark, cfg):
    layout = Layout(scratch_path(spark, "records-base"))
    run_stream(spark, layout, replace(cfg, batch_metrics=None))
    assert [r.rows_processed for r in spark.read.parquet(layout.metrics).collect()] == [9]
    assert sorted(r.rows_processed for r in spark.read.parquet(layout.batch_metrics).collect()) == [1, 4, 4]
    again = replace(cfg, batch_metrics=layout.batch_metrics)
    drain(spark, again)  # nothing new: no batch, no record
    assert spark.read.parquet(layout.batch_metrics).count() == 3
