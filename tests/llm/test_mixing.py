"""Mixtures against their definition."""

import collections
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.llm import mixing
from stratum.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.01"


def test_query_matches_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    out = REGISTRY["op7_temperature_mixing"](spark, SF)
    want = con.execute(ORACLE["op7_temperature_mixing"])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(out.columns)
    got = sorted(tuple(r[c] for c in cols) for r in out.collect())
    assert got == sorted(want.fetchall())
    assert {r[0] for r in got} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def corpus(spark, extra=()):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{min(i % 10, 3)}") for i in range(400)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, source string")


@pytest.mark.parametrize("limit", [1.0, 1.7, 3.0, 100.0])
def test_repetition_limit(spark, limit):
    docs = corpus(spark).withColumn("tokens", mixing.n_tokens("text"))
    m = mixing.mixture(spark, docs, max_repeat=limit)
    rows = m.sources.collect()
    rates = [r.quota / r.tokens for r in rows]
    natural = max(r.tokens for r in rows) / min(r.tokens for r in rows)
    assert max(rates) / min(rates) == pytest.approx(min(limit, natural), rel=1e-3)
    assert min(rates) == pytest.approx(1) and sum(r.weight for r in rows) == pytest.approx(1)


def test_target_entropy_and_budget(spark):
    docs = corpus(spark).withColumn("tokens", mixing.n_tokens("text"))
    m = mixing.mixture(spark, docs, entropy=1.2, budget=5000)
    w = [r.weight for r in m.sources.collect()]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(1.2, abs=1e-6)
    assert sum(r.quota for r in m.sources.collect()) == pytest.approx(5000, abs=3)


@pytest.mark.parametrize("block", [1 << 20, 300, 1])
def test_budgets_are_kept(spark, block):
    """Whole passes, then a part: never over the budget, short by less than the
    first document that doesn't fit."""
    docs = corpus(spark, [(1000, None, "s1"), (1001, "", "empty"), (None, "a b", None), (1003, "a", None), (1003, "a", None)])
    m = {r.source: r for r in mixing.mixture(spark, docs.withColumn("tokens", mixing.n_tokens("text"))).sources.collect()}
    used = collections.defaultdict(lambda: collections.defaultdict(list))
    rows = mixing.mix(spark, docs, block_tokens=block, details=True).collect()
    for r in rows:
        used[r.source][r["pass"]].append((r.doc_id, r.tokens))
    whole = collections.defaultdict(list)
    for r in docs.withColumn("tokens", mixing.n_tokens("text")).collect():
        whole[r.source].append((r.doc_id, r.tokens))
    key = lambda x: (str(x[0]), x[1])
    for s, w in whole.items():
        for p in range(1, m[s].passes + 1):
            assert sorted(used[s][p], key=key) == sorted(w, key=key)
        rest = used[s].get(m[s].passes + 1, [])
        taken = sum(t for _, t in rest)
        assert taken <= m[s].part < taken + max(t for _, t in w) + 1 + (2 if s is None else 0)
    assert len(used["empty"][1]) == 1 and m["empty"].weight == 0


def test_edges(spark):
    docs = corpus(spark).selectExpr("*", "1 AS tokens", "'x' AS passes", "2 AS cut", "3 AS block")
    out = mixing.mix(spark, docs)
    assert out.columns == docs.columns and out.select("doc_id").distinct().count() == 400
    assert sorted(out.collect()) == sorted(mixing.mix(spark, docs.repartition(7)).collect())
    assert sorted(out.collect()) != sorted(mixing.mix(spark, docs, key="other").collect())
    assert mixing.mix(spark, docs.limit(0)).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert mixing.mix(spark, blank).count() == 400
