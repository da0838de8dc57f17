"""Daily states of the indicator: what is read, reruns, failures."""

import shutil

import pytest

from stratum.operators.bronze import EmptySourceError, indicator_of
from stratum.plans import incremental as inc
from stratum.session import scratch_path
from stratum.sources import versions
from stratum.sources.registry import SourceRegistry
from stratum.spec import DEFAULT_SPEC as S

SCHEMA = f"{S.entity} string, {S.period} int, {S.score_raw} double, {S.flag_raw} string, {S.weight_raw} double"
A = [("a", 2024, 10.0, "1", 2.0), ("a", 2024, None, "0", 1.0), (None, 2024, 5.0, "1", 1.0)]
B = [("a", 2024, 30.0, None, 1.0), ("b", 2023, 1.0, "1", 0.0), ("c", 2024, None, "1", None)]
C = [("b", 2023, 2.0, "0", 4.0), (None, 2024, 7.0, "0", 3.0)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_days_add_up_to_the_whole(spark):
    base = scratch_path(spark, "daily")
    for day, part in (("d1", A), ("d2", B), ("d3", C)):
        inc.add_day(spark, base, day, frame(spark, part))
    whole = indicator_of(frame(spark, A + B + C))
    assert rows(inc.read_indicator(spark, base)) == rows(whole.select(*inc.read_indicator(spark, base).columns))
    assert inc.days(spark, base) == ["d1", "d2", "d3"]


def test_a_new_day_reads_no_earlier_day(spark, tmp_path):
    """Microdata and daily states of earlier days are gone before the next one comes."""
    base = scratch_path(spark, "daily")
    for day, part in (("d1", A), ("d2", B), ("d3", C)):
        micro = f"{tmp_path}/{day}"
        frame(spark, part).write.parquet(micro)
        inc.add_day(spark, base, day, spark.read.parquet(micro))
        shutil.rmtree(micro)
        shutil.rmtree(f"{base}/daily/dia={day}".removeprefix("file:"))
    assert rows(inc.read_indicator(spark, base)) == rows(indicator_of(frame(spark, A + B + C)).select(
        *inc.read_indicator(spark, base).columns))


def test_a_day_that_comes_again_replaces_itself(spark):
    base = scratch_path(spark, "daily")
    inc.add_day(spark, base, "d1", frame(spark, A))
    inc.add_day(spark, base, "d2", frame(spark, C))
    inc.add_day(spark, base, "d2", frame(spark, C))
    assert rows(inc.read_indicator(spark, base)) == rows(indicator_of(frame(spark, A + C)).select(*inc.read_indicator(spark, base).columns))
    inc.add_day(spark, base, "d1", frame(spark, B))  # a correction
    assert rows(inc.read_indicator(spark, base)) == rows(indicator_of(frame(spark, B + C)).select(*inc.read_indicator(spark, base).columns))
    reg = SourceRegistry().add_daily("indicador", base)
    assert rows(reg.read(spark, "indicador")) == rows(inc.read_indicator(spark, base))


def test_a_run_that_dies_is_run_again(spark, monkeypatch):
    base = scratch_path(spark, "daily")
    inc.add_day(spark, base, "d1", frame(spark, A))

    def die(*a, **k):
        raise OSError("disk")

    monkeypatch.setattr(inc, "publish", die)
    with pytest.raises(OSError):
        inc.add_day(spark, base, "d2", frame(spark, B))
    assert inc.days(spark, base) == ["d1"]
    monkeypatch.setattr(inc, "publish", versions.publish)
    inc.add_day(spark, base, "d2", frame(spark, B))
    assert rows(inc.read_indicator(spark, base)) == rows(indicator_of(frame(spark, A + B)).select(*inc.read_indicator(spark, base).columns))


def test_an_empty_day_changes_nothing(spark):
    base = scratch_path(spark, "daily")
    with pytest.raises(EmptySourceError):
        inc.add_day(spark, base, "d1", frame(spark, []))
    assert inc.days(spark, base) == []
