"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from stratum.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id_municipio", "nome_municipio", "sigla_uf", "ano", "percentual_alfabetizado",
                          "meta_percentual", "gap_para_meta", "atingiu_meta"]


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert canon(got, df.columns) == canon(want, want_cols)
