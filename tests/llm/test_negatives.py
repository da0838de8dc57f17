"""Hard negatives against brute force."""

import duckdb
import numpy as np
import pytest

from stratum.llm import negatives
from stratum.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.01"
SCHEMA = "id long, label int, vector array<double>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def slow(rows, anchors, k=5, n=10):
    out = []
    ints = [(i, lab, np.floor(256 * np.asarray(v, float)).astype(int).tolist()) for i, lab, v in rows]
    for i, lab, v in anchors:
        a = np.floor(256 * np.asarray(v, float)).astype(int).tolist()
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, other) for j, other, b in ints if j != i)
        for s, j, _ in [x for x in scored if x[2] == lab][:k]:
            hard = [x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:n]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(hard)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def embeddings(spark):
    return [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, np.array(r.embedding, float))
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]


def test_query(spark, embeddings):
    df = REGISTRY["op11_shared_list_negatives"](spark, SF)
    assert dict(df.dtypes) == {c: "int" if c == "rank" else "bigint" for c in COLUMNS}
    want = slow(embeddings, [r for r in embeddings if r[0] % 100 == 0])
    assert got(df) == want and len(want) > 50


def test_oracle(embeddings):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert sorted(con.execute(ORACLE["op11_shared_list_negatives"]).fetchall()) == slow(
        embeddings, [r for r in embeddings if r[0] % 100 == 0])


def test_small_blocks_shards_and_groups(spark, embeddings):
    rows = [(i, lab, v.tolist()) for i, lab, v in embeddings[:600]]
    df = spark.createDataFrame(rows, SCHEMA)
    out = negatives.mine(spark, df, df.where("id % 10 = 0"), shard=50, block=7, group=3, stride=5)
    assert got(out) == slow(rows, [r for r in rows if r[0] % 10 == 0])


def test_lists_are_left_early():
    """Clustered data: a member leaves its shared list before the end, and has the right best."""
    rng = np.random.default_rng(3)
    heads = rng.normal(size=(40, 16))
    x = np.repeat(heads, 100, axis=0) + 0.02 * rng.normal(size=(4_000, 16))
    s = negatives._candidates(np.arange(4_000), np.repeat(np.arange(40), 100) % 10, list(x))
    s |= {n: s[n].reshape(-1, 16) for n in ("x", "unit")}
    anchors = x[:100:9]
    b = negatives._block(np.arange(12), np.arange(0, 100, 9)[:12], np.zeros(12, int), list(anchors))
    b |= {"x": b["x"].reshape(-1, 16)}
    best = negatives.Best(12, 5, np.full(12, -(1 << 63)))
    walked = 0

    def needed():
        best.settle()
        return best.kth

    for on, scores, labels, column, ids in negatives.walk(s, b, needed, 5, 50):
        walked += len(column)
        row, at = np.nonzero(np.ones((len(on), len(column)), bool))
        best.offer(on[row], scores[row, column[at]], ids[at])
    best.settle()
    assert walked < 1_000
    every = np.floor(256 * anchors) @ np.floor(256 * x).T
    for r in range(12):
        assert best.score[best.row == r].tolist() == sorted(every[r].astype(int).tolist())[::-1][:5]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (1, 1, [1.0, 0.1]), (2, 1, [1.0, 0.1]), (3, 2, [0.5, 0.0]),
            (4, 2, [0.5, 0.0]), (5, None, [9.0, 9.0]), (6, 2, None), (7, 2, [nan, 0.0]), (8, 2, [inf, 0.0]),
            (9, 2, [None, 0.5]), (None, 2, [0.6, 0.0]), (10, 3, [0.7]), (11, 3, []), (12, 4, [0.0, 0.0]), (13, 4, [0.0, 0.0]),
            (14, 5, [-1.0, 0.0]), (15, 5, [1.0, 0.0]), (0, 1, [0.9, 0.0]), (16, 2, [0.5, 0.0, 0.0])]
    rows += [(100 + i, 2, [0.5, 0.0]) for i in range(30)]  # ties by the dozen
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    fine = [r for r in rows if None not in r and r[0] not in (7, 8, 9, 11)]
    anchors = df.where("id IN (0, 1, 5, 9, 12, 14)")
    want = slow(fine, [r for r in fine if r[0] in (0, 1, 12, 14)])
    assert got(negatives.mine(spark, df, anchors, shard=7, block=2, group=2, stride=3)) == want
    assert got(negatives.mine(spark, df, anchors)) == want and len(want) > 20
    assert negatives.mine(spark, df.limit(0), anchors).count() == 0
    assert negatives.mine(spark, df, df.limit(0)).count() == 0


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(0, 1, [1e7, 1.0]), (1, 1, [1e7, 3.0]), (2, 2, [7e6, 2.0]), (3, 2, [7e6, 2.5]), (4, 2, [1e300, 0.0]),
            (5, 1, [-1e308, 1e308])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = got(negatives.mine(spark, df, df.where("id = 0"), positives=1))
    assert out == slow([r for r in rows if r[0] < 4], rows[:1], k=1) and len(out) == 2  # exact in a long, not in a double
    most = got(negatives.mine(spark, df, df.where("id = 5"), positives=1))
    assert all(-(1 << 63) <= r[5] < 1 << 63 for r in most)
