"""Dates and histories of Bronze tables whose columns and types changed."""

import pytest
from pyspark.sql import functions as F

from stratum.session import scratch_path
from stratum.sources import bronze

SCHEMAS = ["k long, v int", "k string, v int", "k string, v long, extra string", "k string, v double, extra string"]


@pytest.fixture()
def table(spark):
    base = scratch_path(spark, "history")
    rows = [[(1, 10)], [("2", 20)], [("x", 2**40, "e")], [("y", 0.5, None)]]
    for k, (schema, data) in enumerate(zip(SCHEMAS, rows)):
        bronze.write_snapshot(spark.createDataFrame(data, schema), base, "t", f"2024-01-0{k + 1}", "b")
    return base


def test_history_has_the_columns_of_any_date(spark, table):
    df = bronze.read_bronze(spark, table, "t", latest=False)
    types = dict(df.dtypes)
    assert (types["k"], types["v"], types["extra"], types["dt_ingestao"]) == ("string", "double", "string", "date")
    assert sorted((r.k, r.v, r.extra, str(r.dt_ingestao)) for r in df.collect()) == [
        ("1", 10.0, None, "2024-01-01"), ("2", 20.0, None, "2024-01-02"),
        ("x", 2.0**40, "e", "2024-01-03"), ("y", 0.5, None, "2024-01-04")]


def test_latest_date_without_a_job(spark, table):
    """Folder names only: no job runs, and the plan reads the last date alone."""
    spark.sparkContext.setJobGroup("dates-only", "")
    assert bronze.dates(spark, f"{table}/t") == [f"2024-01-0{k}" for k in range(1, 5)]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("dates-only")) == []
    latest = bronze.read_bronze(spark, table, "t")
    assert latest.columns[:3] == ["k", "v", "extra"] and latest.count() == 1
    assert {f.split("dt_ingestao=")[1][:10] for f in latest.inputFiles()} == {"2024-01-04"}
    early = bronze.read_bronze(spark, table, "t", latest=False).where(F.col("dt_ingestao") == "2024-01-01")
    assert early.select("k").collect()[0].k == "1"


@pytest.mark.parametrize("kinds, want", [({"int"}, "int"), ({"int", "bigint"}, "bigint"), ({"int", "double"}, "double"),
                                         ({"float", "double"}, "double"), ({"int", "string"}, "string"),
                                         ({"date", "string"}, "string"), ({"array<int>"}, "array<int>")])
def test_common_type(kinds, want):
    assert bronze.common_type(kinds) == want


def test_no_dates(spark):
    path = scratch_path(spark, "plain")
    spark.range(3).write.parquet(f"{path}/t")
    assert bronze.dates(spark, f"{path}/none") == []
    assert bronze.read_bronze(spark, path, "t").count() == bronze.read_bronze(spark, path, "t", latest=False).count() == 3
