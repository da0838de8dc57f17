"""Micro-batches bounded by messages or time: places, restarts, edges."""

import json

import pytest
from pyspark.sql import functions as F

from stratum.session import scratch_path
from stratum.streaming.events import BATCH, RAW, StreamConfig, drain, run_for
from stratum.streaming.landing import LandedReader


def reader(tmp_path, **options):
    (tmp_path / "in").mkdir(exist_ok=True)
    return LandedReader({"path": str(tmp_path / "in"), "log": str(tmp_path / "log"),
                         **{k: str(v) for k, v in options.items()}})


def lines(r, start, end):
    return [x for p in r.partitions(start, end) for b in r.read(p) for x in b.column(0).to_pylist()]


def test_a_batch_ends_within_a_file(tmp_path):
    r = reader(tmp_path, max_messages=4, max_seconds=0, task_bytes=5)
    (tmp_path / "in" / "a").write_bytes(b"1\n2\n3")
    (tmp_path / "in" / "sub").mkdir()
    (tmp_path / "in" / "sub" / "b").write_bytes("4\r\né5é\n\n7\n8\n".encode())
    (tmp_path / "in" / "sub" / "_hidden").write_text("x\n")
    at, got = r.initialOffset(), []
    while (end := r.latestOffset()) != at:
        got.append(lines(r, at, end))
        at = end
    assert got == [["1", "2", "3", "4"], ["é5é", "", "7", "8"]]


def test_waits_for_more_until_the_time_is_up(tmp_path):
    r = reader(tmp_path, max_messages=3, max_seconds=60)
    now = [0.0]
    r.clock = lambda: now[0]
    assert r.latestOffset() == {"file": 0, "byte": 0}
    (tmp_path / "in" / "a").write_text("1\n2\n")
    start = r.latestOffset()
    now[0] = 59.0
    assert r.latestOffset() == start
    now[0] = 60.0
    end = r.latestOffset()
    assert lines(r, start, end) == ["1", "2"]
    (tmp_path / "in" / "b").write_text("3\n4\n5\n6\n")
    assert lines(r, end, r.latestOffset()) == ["3", "4", "5"]  # full at once


def test_a_restart_goes_on_where_it_was(tmp_path):
    r = reader(tmp_path, max_messages=2, max_seconds=0)
    (tmp_path / "in" / "m").write_text("1\n2\n3\n")
    a = r.latestOffset()
    assert lines(r, r.initialOffset(), a) == ["1", "2"]
    (tmp_path / "in" / "b").write_text("4\n")  # an earlier name, found later
    again = reader(tmp_path, max_messages=2, max_seconds=0)
    b = again.latestOffset()
    assert lines(again, a, b) == ["3", "4"]
    replay = reader(tmp_path, max_messages=2, max_seconds=0)
    assert lines(replay, {"file": 0, "byte": 0}, a) == ["1", "2"]  # an uncommitted batch, planned again
    third = reader(tmp_path, max_messages=2, max_seconds=0)
    third.partitions(a, b)
    assert third.latestOffset() == b


def test_empty_and_missing_folders(tmp_path):
    r = LandedReader({"path": str(tmp_path / "none"), "log": str(tmp_path / "log")})
    assert r.latestOffset() == r.initialOffset() and r.partitions(r.initialOffset(), r.initialOffset()) == []
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty").write_text("")
    r = reader(tmp_path, max_seconds=0)
    end = r.latestOffset()
    assert lines(r, r.initialOffset(), end) == []


@pytest.fixture()
def cfg(spark):
    base = scratch_path(spark, "landed")
    return StreamConfig(landing=f"{base}/landing", bronze=f"{base}/bronze", quarantine=f"{base}/quarantine",
                        checkpoint=f"{base}/checkpoint", max_messages=3)


def event(i):
    return json.dumps({"event_id": i, "event_type": "view"})


def test_stored_batches_and_a_lost_commit(spark, cfg):
    """A micro-batch whose commit is lost is written again, once."""
    import shutil

    from pyspark.sql import types as T

    def land(name, rows):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{cfg.landing}/{name}")

    land("one", [event(0), event(1), "broken", event(2), event(3), " ", event(4)])
    d = drain(spark, cfg)
    assert (d.rows_in, d.bronze_rows, d.quarantine_rows) == (7, 5, 2)
    commits = f"{cfg.checkpoint}/events/commits".removeprefix("file:")
    shutil.os.remove(f"{commits}/2")
    shutil.os.remove(f"{commits}/.2.crc")
    land("two", [event(5)])
    drain(spark, cfg)
    stored = spark.read.schema(T.StructType.fromDDL(f"event_id long, {RAW} string, {BATCH} string")).parquet(cfg.bronze)
    assert sorted(r.event_id for r in stored.collect()) == [0, 1, 2, 3, 4, 5]
    assert stored.groupBy(BATCH).count().agg(F.max("count")).first()[0] <= 3


def test_run_for_writes_what_waits_at_the_end(spark, cfg):
    spark.createDataFrame([(event(i),) for i in range(4)], "value string").coalesce(1).write.text(f"{cfg.landing}/one")
    d = run_for(spark, cfg, 8)
    assert d.rows_in == 4
    sizes = sorted(r["count"] for r in spark.read.parquet(cfg.bronze).groupBy(BATCH).count().collect())
    assert sizes == [1, 3]
