"""Many micro-batches of a backlog in one trigger: same batches, fewer triggers."""

import json
import os
from dataclasses import replace

import pytest

from stratum.session import scratch_path
from stratum.streaming.events import BATCH, StreamConfig, drain
from stratum.streaming.landing import LandedReader


def reader(tmp_path, **options):
    return LandedReader({"path": str(tmp_path / "in"), "log": str(tmp_path / "log"), "max_seconds": "0",
                         **{k: str(v) for k, v in options.items()}})


def parts(r, start, end):
    out = {}
    for p in r.partitions(start, end):
        for b in r.read(p):
            for value, part in zip(*(c.to_pylist() for c in b.columns)):
                out.setdefault(part, []).append(value)
    return out


def test_a_trigger_takes_full_batches_over_files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("".join(f"{i}\n" for i in range(7)))
    (tmp_path / "in" / "b").write_text("\n".join(f"{i}" for i in range(7, 15)))  # the last line has no line feed
    r = reader(tmp_path, max_messages=2, max_batches=4)
    at, got, triggers = r.initialOffset(), {}, []
    while (end := r.latestOffset()) != at:
        first = len(triggers)
        found = parts(r, at, end)
        # planned again by other settings, the same micro-batches
        assert parts(reader(tmp_path, max_messages=5, task_bytes=3), at, end) == found
        got |= {first + k: v for k, v in found.items()}
        triggers.append(len(found))
        at = end
    assert triggers == [1, 2, 4, 1]
    assert got == {k: [str(i) for i in range(2 * k, min(2 * k + 2, 15))] for k in range(8)}


@pytest.fixture()
def cfg(spark):
    base = scratch_path(spark, "many")
    rows = [(json.dumps({"event_id": i}) if i % 5 else "broken",) for i in range(41)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{base}/landing/one")
    return StreamConfig(landing=f"{base}/landing", bronze=f"{base}/bronze", quarantine=f"{base}/quarantine",
                        checkpoint=f"{base}/checkpoint", max_messages=2, batch_metrics=f"{base}/batches")


def test_a_backlog_needs_few_triggers_and_a_lost_batch_keeps_those_before(spark, cfg):
    def records():
        return sorted((r.batch_id, r.rows_processed) for r in spark.read.parquet(cfg.batch_metrics).collect())

    def stored():
        rows = spark.read.parquet(cfg.bronze).unionByName(spark.read.parquet(cfg.quarantine), allowMissingColumns=True)
        return sorted((int(r[BATCH].rpartition("-")[2]), r["count"]) for r in rows.groupBy(BATCH).count().collect())

    def die(number):
        if number == 5:  # third of the trigger that holds 3 to 6
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        drain(spark, replace(cfg, on_batch=die))
    assert records() == stored() == [(k, 2) for k in range(5)]
    assert drain(spark, cfg).rows_in == 41 - 6
    assert records() == stored() == [(k, 2) for k in range(20)] + [(20, 1)]
    commits = os.listdir(f"{cfg.checkpoint}/events/commits".removeprefix("file:"))
    assert len([c for c in commits if c.isdigit()]) < 10  # 21 micro-batches


def test_only_single_objects_are_parsed_for_their_fields(spark):
    """Broken texts leave no fields behind, and the texts that are no objects no parse."""
    from pyspark.sql import functions as F

    from stratum.streaming.events import CORRUPT, EVENT_SCHEMA, RAW, parse
    texts = ['{"event_id": 1}', '{"event_id": 2} junk', '{"event_id": 3} {"event_id": 4}', '[{"event_id": 5}]', "", None]
    out = parse(spark.createDataFrame([(t,) for t in texts], f"{RAW} string"), EVENT_SCHEMA)
    assert [(r.event_id, r[CORRUPT]) for r in out.collect()] == [(1, False)] + [(None, True)] * 5
    assert out.where(~F.col(CORRUPT)).count() == 1
