"""Ball-tree top-k and projected neighbours against brute force."""

import math

import duckdb
import numpy as np
import pytest

from stratum.llm import balltree, projections
from stratum.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.01"
SCHEMA = "id long, vector array<double>"


def slow_products(rows, queries, k):
    out = {}
    for q, u in queries:
        a = np.floor(64 * np.asarray(u, float)).astype(int).tolist()
        scores = []
        for i, v in rows:
            b = np.floor(64 * np.asarray(v, float)).astype(int).tolist()
            if i != q:
                scores.append((-sum(x * y for x, y in zip(a, b)), i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def slow_cosines(rows, queries, k):
    out = {}
    for q, u in queries:
        u = np.asarray(u, float)
        scores = sorted((-float(np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v))), i)
                        for i, v in rows if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    return [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]


def test_top_k_query(spark, embeddings):
    got = by_query(REGISTRY["op9_ball_tree_top_k"](spark, SF))
    assert got == slow_products(embeddings, [x for x in embeddings if x[0] % 20 == 0], 20)


def test_top_k_oracle(embeddings):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    got = {}
    for q, _, v, s in sorted(con.execute(ORACLE["op9_ball_tree_top_k"]).fetchall()):
        got.setdefault(q, []).append((v, s))
    assert got == slow_products(embeddings, [x for x in embeddings if x[0] % 20 == 0], 20)


def test_neighbours_query(spark, embeddings):
    got = by_query(REGISTRY["op10_projected_neighbours"](spark, SF))
    want = slow_cosines(embeddings, [x for x in embeddings if x[0] % 50 == 0], 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hit = [i in dict(got[q]) for q in want for i, _ in want[q]]
    assert sum(hit) / len(hit) >= 0.95
    for q, found in got.items():
        u = dict(embeddings)[q]
        for i, s in found:
            v = dict(embeddings)[i]
            assert s == pytest.approx(np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)), abs=1e-14)


@pytest.mark.parametrize("shard", [37, 5000])
def test_ties_and_many_shards(spark, shard):
    rnd = np.random.default_rng(shard)
    x = [(i, rnd.normal(0, .2, 6)) for i in range(300)]
    x += [(1000 - i, x[5][1]) for i in range(60)]  # a group of copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x], SCHEMA)
    q = df.where("id % 20 = 0 OR id IN (5, 990, 991)")
    qs = [y for y in x if y[0] % 20 == 0 or y[0] in (5, 990, 991)]
    assert by_query(balltree.exact_top_k(spark, df, q, shard=shard, block=7)) == slow_products(x, qs, 20)
    got = by_query(projections.nearest(spark, df, q, confidence=0.999999, shard=shard, block=7))
    for i, want in slow_cosines(x, qs, 5).items():
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want])
    assert [i for i, _ in got[5]] == [941, 942, 943, 944, 945] and [i for i, _ in got[990]] == [5, 941, 942, 943, 944]


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1.0, 0.0, 2.0]), (4, None), (5, []),
            (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [None, 1.0]), (9, [0.0, 0.0]), (None, [1.0, 1.0]),
            (10, [-1e5, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS shard")
    queries = df.dropDuplicates(["id"])
    got = by_query(balltree.exact_top_k(spark, df, queries))
    assert sorted(got) == [1, 2, 3, 9, 10]
    assert got[1] == [(3, 4096), (2, 2048), (2, 2048), (9, 0), (10, -64 * 6400000)]
    near = by_query(projections.nearest(spark, df, queries))
    assert sorted(near) == [1, 2, 3, 10] and [i for i, _ in near[1]] == [2, 2, 3, 10]
    for f in (balltree.exact_top_k, projections.nearest):
        assert f(spark, df.limit(0), df).count() == 0 and f(spark, df, df.limit(0)).count() == 0
        assert f(spark, df.where("id = 1"), df.where("id = 1")).count() == 0


def test_components_out_of_range(spark):
    """Products beyond doubles and longs, scaled components beyond doubles, and
    squares that vanish or overflow."""
    rows = [(1, [1e7, 1.0]), (2, [1e7, 3.0]), (3, [1e9, 2.0]), (4, [-1e300, 0.0]), (5, [1.7e308, 1e308]), (6, [1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_query(balltree.exact_top_k(spark, df, df))
    want = slow_products([r for r in rows if r[0] in (2, 6)], [rows[0]], 20)
    assert [x for x in got[1] if x[0] in (2, 6)] == want[1]  # fits a long, not a double
    most = (1 << 63) - 1
    assert got[1][:2] == [(3, most), (5, most)] and got[1][-1] == (4, -most - 1) and len(got) == 6
    tiny = [(1, [1e-200, 0.0]), (2, [1e-200, 1e-200]), (3, [1e200, 0.0]), (4, [0.0, 3.0]), (5, [5e-324, 0.0])]
    df = spark.createDataFrame(tiny, SCHEMA)
    near = by_query(projections.nearest(spark, df, df))
    assert near[1] == [(3, 1.0), (5, 1.0), (2, pytest.approx(0.5 ** 0.5)), (4, 0.0)] and len(near) == 5


@pytest.mark.parametrize("group", [1, 3])
def test_groups_of_shards_are_merged(spark, group, embeddings):
    rows = [(i, v.tolist()) for i, v in embeddings[:400]]
    df = spark.createDataFrame(rows, SCHEMA)
    q, qs = df.where("id % 20 = 0"), [r for r in rows if r[0] % 20 == 0]
    assert by_query(balltree.exact_top_k(spark, df, q, shard=40, block=6, group=group)) == slow_products(rows, qs, 20)
    got = by_query(projections.nearest(spark, df, q, confidence=0.999999, shard=40, block=6, group=group))
    assert {k: [i for i, _ in v] for k, v in got.items()} == {k: [i for i, _ in v] for k, v in slow_cosines(rows, qs, 5).items()}


def test_chi_square_quantile():
    assert projections.chi_square_quantile(0.95, 2) == pytest.approx(5.991464547)
    assert projections.chi_square_quantile(0.99, 8) == pytest.approx(20.09023503)
