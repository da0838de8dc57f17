"""Published versions: readers, failed builds, two builds at once, expiry."""

import threading

import pytest
from pyspark.sql import functions as F

from stratum.session import scratch_path
from stratum.sources import files, versions
from stratum.sources.metrics import METRIC_SCHEMA, RunMetric, append_metrics


def _put(spark, base, value, keep=3):
    versions.publish(spark, base, lambda folder: spark.range(value, value + 2).write.parquet(folder), keep=keep)


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_a_reader_keeps_its_version(spark):
    base = scratch_path(spark, "versions")
    with pytest.raises(versions.NotPublishedError):
        versions.current(spark, base)
    _put(spark, base, 1)
    before = spark.read.parquet(versions.current(spark, base))
    _put(spark, base, 5)
    assert _ids(before) == [1, 2] and _ids(spark.read.parquet(versions.current(spark, base))) == [5, 6]


def test_a_failed_build_changes_nothing(spark):
    base = scratch_path(spark, "versions")
    _put(spark, base, 1)

    def half(folder):
        rows = spark.range(0, 100, 1, 10).withColumn("x", F.when(F.col("id") > 90, F.raise_error(F.lit("lost"))).otherwise(1))
        rows.write.parquet(folder)

    with pytest.raises(Exception, match="lost"):
        versions.publish(spark, base, half)
    assert _ids(spark.read.parquet(versions.current(spark, base))) == [1, 2] and len(versions.published(spark, base)) == 1


def test_builds_that_end_together_both_count(spark):
    base = scratch_path(spark, "versions")
    gate = threading.Barrier(4)

    def build(k):
        versions.publish(spark, base, lambda folder: (spark.range(k, k + 2).write.parquet(folder), gate.wait()), keep=10)

    threads = [threading.Thread(target=build, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(set(versions.published(spark, base))) == 4


def test_expiry_keeps_the_last(spark):
    base = scratch_path(spark, "versions")
    for k in range(5):
        _put(spark, base, k, keep=2)
    left = versions.published(spark, base)
    assert [_ids(spark.read.parquet(f)) for f in left] == [[3, 4], [4, 5]]
    assert {n for n in files.names(spark, base) if n.startswith("v-")} == {f.rsplit("/", 1)[1] for f in left}


@pytest.mark.parametrize("kind", [files._Hadoop, files._Arrow])
def test_small_files(spark, tmp_path, kind):
    at = f"{tmp_path}/a"
    f = kind(spark, at) if kind is files._Hadoop else kind(at)
    assert f.read(f"{at}/x") is None and f.names(at) == []
    f.write(f"{at}/x", b"one")
    f.write(f"{at}/y", b"two")
    assert f.read(f"{at}/x") == b"one" and not f.rename(f"{at}/x", f"{at}/y") and f.rename(f"{at}/x", f"{at}/z")
    assert [n for n in sorted(f.names(at)) if not n.startswith(".")] == ["y", "z"]
    f.delete(f"{at}/y")
    f.delete(f"{at}/none")
    f.delete(at)
    assert f.names(at) == []


def test_metric_records_without_a_job(spark):
    base = scratch_path(spark, "metrics")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("metrics-only", "")
    append_metrics(spark, [RunMetric("a", "bronze", 3, 0.5, "t")], base)
    append_metrics(spark, [RunMetric("b", "gold", 4, 1.5, "u"), RunMetric("c", "gold", 0, 0.0, "v")], base)
    assert list(status.getJobIdsForGroup("metrics-only")) == []
    back = spark.read.parquet(base)
    assert back.schema == METRIC_SCHEMA and sorted(tuple(r)[:3] for r in back.collect()) == [
        ("a", "bronze", 3), ("b", "gold", 4), ("c", "gold", 0)]
