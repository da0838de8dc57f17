"""Stored entity sets against sets in Python."""

import random

from stratum.plans import coverage as cov
from stratum.session import scratch_path
from stratum.spec import DEFAULT_SPEC as S

SCHEMA = f"{S.entity} string, {S.period} int"


def expected(held):
    union = set().union(*held.values()) if held else set()
    by = {p: (len(x), len(x & held.get(p - 1, set()))) for p, x in held.items() if x}
    return len(union), by


def found(spark, base):
    sets = cov.read_sets(spark, base)
    return (cov.distinct_entities(sets).first()[0],
            {r[S.period]: (r[cov.BY_PERIOD], r[cov.AGAIN]) for r in cov.entities_by_period(sets).collect()})


def test_periods_added_and_replaced(spark):
    rnd, base, held = random.Random(1), scratch_path(spark, "sets"), {}
    for periods in ([2020, 2022], [2021], [2022, 2023], [2021]):
        rows = []
        for p in periods:
            held[p] = {f"e{rnd.randrange(120)}" for _ in range(rnd.randrange(40, 90))}
            rows += [(e, p) for e in held[p]] * 2 + [(None, p)]
        cov.add_periods(spark, base, spark.createDataFrame(rows, SCHEMA), buckets=3)
        assert found(spark, base) == expected(held)


def test_more_entities_than_a_bitmap_holds(spark):
    base = scratch_path(spark, "sets")
    rows = spark.range(70_000).selectExpr(f"concat('e', id) AS {S.entity}", f"if(id % 2 = 0, 1, 2) AS {S.period}")
    cov.add_periods(spark, base, rows, buckets=1)
    assert found(spark, base) == (70_000, {1: (35_000, 0), 2: (35_000, 0)})
    more = spark.range(69_000, 80_000).selectExpr(f"concat('e', id) AS {S.entity}", f"3 AS {S.period}")
    cov.add_periods(spark, base, more)
    assert found(spark, base) == (80_000, {1: (35_000, 0), 2: (35_000, 0), 3: (11_000, 500)})


def test_reads_only_sets(spark):
    base = scratch_path(spark, "sets")
    cov.add_periods(spark, base, spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], SCHEMA))
    files = cov.distinct_entities(cov.read_sets(spark, base)).inputFiles()
    assert files and all(f"/{cov.SETS}/" in f for f in files)


def test_empty(spark):
    base = scratch_path(spark, "sets")
    cov.add_periods(spark, base, spark.createDataFrame([], SCHEMA))
    assert found(spark, base) == (0, {})
    cov.add_periods(spark, base, spark.createDataFrame([("a", 1)], SCHEMA))
    assert found(spark, base) == (1, {1: (1, 0)})
