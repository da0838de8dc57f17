"""Property tests: checks and aggregates against brute force in Python on
random small tables (NULLs, repeated keys, NaN and edge values included)."""

import math
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators import quality as dq
from stratum.operators.bronze import weighted_indicator
from stratum.operators.reshape import goals_long

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
years = st.one_of(st.none(), st.sampled_from([2023, 2024]))
values = st.one_of(st.none(), st.sampled_from([-5.0, -0.0000005, 0.0, 12.5, 100.0, 100.0000005, 100.5]),
                   st.just(float("nan")))
rows = st.lists(st.tuples(keys, years, values), max_size=25)


def one(df):
    return dq.collect_results(df)[0]


@SETTINGS
@given(rows)
def test_duplicates_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, y int, v double")
    got = one(dq.duplicate_check(df, ["k", "y"])).metrics
    distinct = len({(k, y) for k, y, _ in data})
    assert got[dq.M_TOTAL] == len(data)
    assert got[dq.M_DUPLICATES] == len(data) - distinct


@SETTINGS
@given(rows)
def test_missing_and_range_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, y int, v double")
    nulls = sum(1 for _, _, v in data if v is None)
    pct = round(nulls / len(data) * 100, 2) if data else 0.0
    assert one(dq.missing_check(df, ["v"])).metrics["v"] == pct
    bad = sum(1 for _, _, v in data if v is not None and (math.isnan(v) or v < -1e-6 or v > 100 + 1e-6))
    assert one(dq.range_check(df, "v")).metrics[dq.M_INVALID] == bad


@SETTINGS
@given(st.lists(keys, max_size=12), st.lists(keys, max_size=12))
def test_orphans_brute_force(spark, child, parent):
    c = spark.createDataFrame([(k,) for k in child], "k string")
    p = spark.createDataFrame([(k,) for k in parent], "k string")
    want = len({k for k in child if k is None or k not in set(parent)})
    assert one(dq.orphan_check(c, p, ["k"])).metrics[dq.M_ORPHANS] == want


@SETTINGS
@given(rows)
def test_fused_suite_equals_single_checks(spark, data):
    df = spark.createDataFrame(data, "k string, y int, v double")
    parent = spark.createDataFrame([("a",)], "k string")
    fused = {r.name: r.metrics for r in dq.collect_results(dq.table_checks(
        df, parent, keys=["k", "y"], missing_cols=["v"], range_col="v", orphan_keys_cols=["k"]))}
    assert fused[dq.DUPLICATES] == one(dq.duplicate_check(df, ["k", "y"])).metrics
    assert fused[dq.MISSING] == one(dq.missing_check(df, ["v"])).metrics
    assert fused["consistencia_v"] == one(dq.range_check(df, "v")).metrics
    assert fused[dq.ORPHANS] == one(dq.orphan_check(df, parent, ["k"])).metrics


micro = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.sampled_from(["1", "0"])),
                           st.sampled_from([0.0, 1.0, 2.0, 5.0]), st.sampled_from([10.0, 20.0, 35.5])),
                 min_size=1, max_size=20)


@SETTINGS
@given(micro)
def test_weighted_indicator_brute_force(spark, data):
    df = spark.createDataFrame(data, "id string, flag string, w double, score double")
    got = {r.id: r for r in weighted_indicator(df, ["id"], "score", "flag", "w",
                                               score_out="s", rate_out="r").collect()}
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    assert set(got) == set(groups)
    for k, rs in groups.items():
        total = sum(r[2] for r in rs)
        hits = sum(r[2] for r in rs if r[1] == "1")
        want = None if total == 0 else round(100 * hits / total, 4)
        assert got[k].r == want
        assert math.isclose(got[k].s, sum(r[3] for r in rs) / len(rs))


goal_rows = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.sampled_from([10.0, 20.0])),
                               st.one_of(st.none(), st.sampled_from([30.0, 50.0]))), min_size=1, max_size=8)


@SETTINGS
@given(goal_rows)
def test_goals_long_brute_force(spark, data):
    wide = spark.createDataFrame(data, "id_municipio string, meta_alfabetizacao_2024 double,"
                                       " meta_alfabetizacao_2025 double")
    got = {(r[0], r[1]): r[2] for r in goals_long(wide, "id_municipio", "meta_alfabetizacao_",
                                                  period="ano", value="meta_percentual").collect()}
    want = {}
    for year, idx in ((2024, 1), (2025, 2)):
        per = defaultdict(list)
        for r in data:
            per[r[0]].append(r[idx])
        for k, vs in per.items():
            present = [v for v in vs if v is not None]
            want[(k, year)] = sum(present) / len(present) if present else None
    assert got == want
    assert Counter(k for k, _ in got) == Counter(k for k, _ in want)


vals = st.lists(st.sampled_from([0.0, 0.1, 0.2, 0.3, 0.35, 1.0, 1.7, 2.4, 33.3333, 50.0, 100.0]),
                min_size=1, max_size=30)


@SETTINGS
@given(vals)
def test_histogram_matches_array_library(spark, data):
    import numpy as np

    from stratum.operators.reporting import histogram

    ind = spark.createDataFrame([(2024, v) for v in data] + [(2023, 999.0)], "ano int, v double")
    got = sorted((r.bin, r["count"], r.bin_start, r.bin_end) for r in histogram(spark, ind, "v", "ano").collect())
    counts, edges = np.histogram(np.array(data), bins=24)
    assert [c for _, c, _, _ in got] == counts.tolist()
    assert [s for _, _, s, _ in got] == edges[:-1].tolist()
    assert [e for _, _, _, e in got] == edges[1:].tolist()


magnitudes = st.builds(lambda m, e, s: s * m * 10.0 ** e, st.floats(1, 9.99), st.integers(-300, 290), st.sampled_from([1, -1]))


@SETTINGS
@given(st.lists(st.one_of(st.none(), magnitudes, st.integers(-10**6, 10**6).map(lambda x: x / 10**4)), max_size=20))
def test_mean_at_any_size(spark, data):
    """The exact mean of fractions, to a relative error of a few roundings of
    the largest value; nothing is cut."""
    from fractions import Fraction

    from stratum.functions import exact_mean
    got = spark.createDataFrame([(v,) for v in data], "v double").agg(exact_mean("v")).first()[0]
    known = [Fraction(v) for v in data if v is not None]
    if not known:
        assert got is None
        return
    want = sum(known) / len(known)
    largest = max(map(abs, known))
    assert abs(Fraction(got) - want) <= largest * len(known) * Fraction(1, 2**50)
    if all(abs(x) < 10**10 and (x * 10**4).denominator == 1 or float(x) in [round(float(x), 4)] for x in known) and largest < 10**9:
        assert got == float(sum(Fraction(str(float(x))) for x in known)) / len(known)  # of short decimals: the exact sum


def test_mean_of_tiny_and_mixed_values(spark):
    from stratum.functions import exact_mean
    for data, mean in (([2e-19], 2e-19), ([1e-300, 3e-300], 2e-300), ([1e300, 2e300], 1.5e300), ([1e12, 0.5], 500000000000.25),
                       ([float("inf"), 1.0], float("inf")), ([0.1] * 10, 0.1)):
        assert spark.createDataFrame([(v,) for v in data], "v double").agg(exact_mean("v")).first()[0] == mean
