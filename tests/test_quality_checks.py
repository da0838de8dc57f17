"""The reference's five data-quality cases, plus the NULL/edge semantics of
each check."""

import pytest

from stratum.operators import quality as dq


def one(df):
    return dq.collect_results(df)[0]


def test_duplicates_found(spark):
    df = spark.createDataFrame([("SP", 2024), ("SP", 2024), ("RJ", 2024)], "sigla_uf string, ano bigint")
    r = one(dq.duplicate_check(df, ["sigla_uf", "ano"]))
    assert not r.passed and r.metrics[dq.M_DUPLICATES] == 1 and r.metrics[dq.M_TOTAL] == 3


def test_no_duplicates(spark):
    df = spark.createDataFrame([("SP", 2024), ("RJ", 2024)], "sigla_uf string, ano bigint")
    assert one(dq.duplicate_check(df, ["sigla_uf", "ano"])).passed


def test_missing_within_limit(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "percentual_alfabetizado double")
    r = one(dq.missing_check(df, ["percentual_alfabetizado"], limit_pct=50.0))
    assert r.passed and not r.critical and r.metrics["percentual_alfabetizado"] == pytest.approx(33.33)


def test_orphans_found(spark):
    child = spark.createDataFrame([("001",), ("002",)], "id_municipio string")
    parent = spark.createDataFrame([("001",)], "id_municipio string")
    r = one(dq.orphan_check(child, parent, ["id_municipio"]))
    assert not r.passed and r.metrics[dq.M_ORPHANS] == 1


def test_out_of_range(spark):
    df = spark.createDataFrame([(101.0,), (50.0,), (-5.0,)], "percentual_alfabetizado double")
    r = one(dq.range_check(df, "percentual_alfabetizado"))
    assert not r.passed and r.metrics[dq.M_INVALID] == 2
    assert r.name == "consistencia_percentual_alfabetizado"


def test_null_keys_are_values_in_duplicate_check(spark):
    # T16: (NULL,1) twice + (a,1) -> one duplicate; count(DISTINCT k1,k2) would say 2
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, n int")
    assert one(dq.duplicate_check(df, ["k", "n"])).metrics[dq.M_DUPLICATES] == 1


def test_missing_share_exactly_at_limit_passes(spark):
    # T17: 1 NULL of 20 = 5.0%, limit 5 -> passes (strict >)
    df = spark.createDataFrame([(None,)] + [(1.0,)] * 19, "v double")
    r = one(dq.missing_check(df, ["v"], limit_pct=5.0))
    assert r.passed and r.metrics["v"] == 5.0


def test_missing_on_empty_table_is_zero(spark):
    df = spark.createDataFrame([], "v double")
    r = one(dq.missing_check(df, ["v"]))
    assert r.passed and r.metrics["v"] == 0.0


def test_null_child_key_is_orphan(spark):
    # T18: NULL never matches, even a NULL parent key
    child = spark.createDataFrame([(None,), ("a",)], "k string")
    parent = spark.createDataFrame([(None,), ("a",)], "k string")
    assert one(dq.orphan_check(child, parent, ["k"])).metrics[dq.M_ORPHANS] == 1


def test_range_tolerance_edges(spark):
    # T20: within tolerance passes, NULL passes, NaN fails
    df = spark.createDataFrame([(100.0000005,), (100.00001,), (-0.0000005,), (None,), (float("nan"),)], "v double")
    assert one(dq.range_check(df, "v")).metrics[dq.M_INVALID] == 2


def test_gate_reports_all_then_raises(spark):
    # T21: every check reported; missing-values failure is a warning only
    df = spark.createDataFrame([("a", 1, None, 150.0), ("a", 1, None, 50.0)],
                               "id string, ano int, score double, rate double")
    parent = spark.createDataFrame([("b",)], "id string")
    checks = dq.table_checks(df, parent, keys=["id", "ano"], missing_cols=["score"], range_col="rate",
                             orphan_keys_cols=["id"])
    lines = []
    with pytest.raises(dq.QualityGateError) as err:
        dq.run_gate(checks, report=lines.append)
    assert len(lines) == 4
    failed = {r.name for r in err.value.failed}
    assert failed == {dq.DUPLICATES, dq.ORPHANS, "consistencia_rate"}
    statuses = {r.name: r.status for r in err.value.results}
    assert statuses[dq.MISSING] == "warn"


def test_fused_checks_equal_single_checks(spark):
    df = spark.createDataFrame([("a", 1, None, 150.0), ("a", 1, 2.0, 50.0), (None, 2, 1.0, None)],
                               "id string, ano int, score double, rate double")
    parent = spark.createDataFrame([("a",)], "id string")
    fused = {r.name: r.metrics for r in dq.collect_results(dq.table_checks(
        df, parent, keys=["id", "ano"], missing_cols=["score", "rate"], range_col="rate",
        orphan_keys_cols=["id"]))}
    assert fused[dq.DUPLICATES] == one(dq.duplicate_check(df, ["id", "ano"])).metrics
    assert fused[dq.MISSING] == one(dq.missing_check(df, ["score", "rate"])).metrics
    assert fused["consistencia_rate"] == one(dq.range_check(df, "rate")).metrics
    assert fused[dq.ORPHANS] == one(dq.orphan_check(df, parent, ["id"])).metrics
