"""Exact top-k inner products by ball-tree branch and bound, shard by shard.

Vectors are dealt to shards evenly.  Each shard is a ball tree
in a file of the shared folder: leaves of neighbouring vectors, and for every
node a centre and radius, which bound the inner product with a query q by
``q . centre + |q| * radius``.  A task takes a block of queries through one
group of shards, one after another; the kth scores found so far go along and
prune the next shard's nodes.  So a task's input does not grow with the tables;
Spark merges the best of all groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import load_arrays, materialize, save_arrays, unique_file
from stratum.session import scratch_path

K = 20
SHARD = 16_384
LEAF = 64
#: Queries, and shards, of a task.
BLOCK = 512
GROUP = 8
#: Sums below this are exact in doubles.
_EXACT = float(1 << 52)


def finite(vector: str) -> Column:
    """Neither null nor with a null, NaN or infinite component; not empty."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """Rows of doubles; shorter vectors count as padded with zeros."""
    if vectors and all(len(v) == dims for v in vectors):
        return np.array(vectors, np.float64)
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def build(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Order of the rows, and the tree over it: ``lo``, ``hi`` (rows), ``left``
    (first child, the other follows it; -1: leaf), ``centre``, ``radius``."""
    order = np.arange(len(x))
    lo, hi, left, centre, radius = [0], [len(x)], [-1], [], []
    at = 0
    while at < len(lo):
        rows = order[lo[at]:hi[at]]
        part = x[rows]
        with np.errstate(over="ignore", invalid="ignore"):  # such nodes are never ruled out
            c = part.mean(axis=0)
            d = np.sqrt(((part - c) ** 2).sum(axis=1))
        centre.append(np.nan_to_num(c))
        radius.append(float(np.nan_to_num(d, nan=np.inf, posinf=np.inf).max()) * (1 + 1e-9) + 1e-12)
        if len(rows) > leaf and d.max() > 0:
            far = part[int(d.argmax())]  # split between two far vectors
            other = part[int(((part - far) ** 2).sum(axis=1).argmax())]
            side = part @ (other - far)
            mid = len(rows) // 2
            order[lo[at]:hi[at]] = rows[np.argpartition(side, mid)]
            left[at] = len(lo)
            lo += [lo[at], lo[at] + mid]
            hi += [lo[at] + mid, hi[at]]
            left += [-1, -1]
        at += 1
    tree = {"lo": np.array(lo), "hi": np.array(hi), "left": np.array(left),
            "centre": np.array(centre), "radius": np.array(radius)}
    return order, tree


def write_shards(spark: SparkSession, vectors: DataFrame, label: str, make, size: int = SHARD) -> list[tuple[str, int]]:
    """Deal (id, vector) rows to files of about ``size`` vectors; ``make(ids,
    vectors)`` gives a shard's arrays.  (file, vectors) of each.  Rows are
    dealt one by one, so a frequent id or vector fills no shard."""
    base = scratch_path(spark, label)
    shards = max(1, -(-vectors.count() // size))

    def write(group: pa.Table) -> pa.Table:
        path = unique_file(base, "shard", ".bin")
        ids, values = group.column("id").to_numpy(), group.column("vector").to_pylist()
        save_arrays(path, make(ids, [np.array(v, np.float64) for v in values]))
        return pa.table({"path": [path], "n": [len(ids)]})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    dealt = materialize(spark, dealt, f"{label}-rows")  # a task that runs again deals the same
    files = dealt.groupBy("shard").applyInArrow(write, "path string, n long")
    return [(r.path, r.n) for r in files.collect()]  # a name for each shard


class TopK:
    """The best k (score, id) of each of some queries, ties to smaller ids."""

    def __init__(self, queries: int, k: int, dtype):
        self.k = k
        worst = np.iinfo(dtype).min if np.issubdtype(dtype, np.integer) else -np.inf
        self.score = np.full((queries, k), worst, dtype)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.found = np.zeros(queries, np.int64)

    @property
    def kth(self) -> np.ndarray:
        """The score that a candidate must reach (-inf while fewer than k are found)."""
        return np.where(self.found >= self.k, self.score[:, -1].astype(float), -np.inf)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """Candidates ``ids`` with ``scores`` [rows, ids]; ``own``: the rows'
        query ids, which don't count."""
        better = np.flatnonzero((scores >= self.kth[rows][:, None]).any(axis=1))
        rows, scores, own = rows[better], scores[better], own[better]
        if not len(rows):
            return
        valid = (ids[None, :] != own[:, None]) & (scores > -np.inf)
        worst = self.score.dtype.type(np.iinfo(self.score.dtype).min
                                      if np.issubdtype(self.score.dtype, np.integer) else -np.inf)
        both = np.concatenate([self.score[rows], np.where(valid, scores, worst)], axis=1)
        names = np.concatenate([self.id[rows], np.where(valid, ids[None, :], np.iinfo(np.int64).max)], axis=1)
        by = np.lexsort((names, -both), axis=1) if np.issubdtype(both.dtype, np.floating) else np.lexsort(
            (names, ~both), axis=1)
        by = by[:, :self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(both, by, 1), np.take_along_axis(names, by, 1)
        self.found[rows] = np.minimum(self.found[rows] + valid.sum(axis=1), self.k)


def descend(tree: dict[str, np.ndarray], bound, kth: np.ndarray):
    """Branch and bound over a shard.  ``bound(nodes, rows)`` [rows, nodes] is
    an upper bound of the scores in a node; yields (rows, lo, hi) to be scored,
    ``kth`` (a function) is asked again after each.  The first leaves visited
    are each query's best ones; then all others that can still matter, the
    highest bounds first."""
    n_rows = len(kth())
    rows = np.arange(n_rows)
    leaves = np.flatnonzero(tree["left"] < 0)
    alive = np.ones((n_rows, len(tree["left"])), bool)
    inner = tree["left"] >= 0
    # top down: what a node's bound rules out, its children needn't be bounded for
    level = np.array([0])
    upper = np.full((n_rows, len(inner)), -np.inf)
    while len(level):
        upper[:, level] = np.where(alive[:, level], bound(level, rows), -np.inf)
        alive[:, level] &= upper[:, level] >= kth()[:, None]
        parents = level[inner[level] & alive[:, level].any(axis=0)]
        children = np.concatenate([tree["left"][parents], tree["left"][parents] + 1]).astype(int)
        alive[:, children] = np.concatenate([alive[:, parents], alive[:, parents]], axis=1)
        level = children
    reached = upper[:, leaves]
    best = reached.argmax(axis=1)
    done = np.zeros(reached.shape, bool)
    for k in np.unique(best):
        at = np.flatnonzero((best == k) & (reached[:, k] > -np.inf) & (reached[:, k] >= kth()))
        if len(at):
            done[at, k] = True
            yield at, int(tree["lo"][leaves[k]]), int(tree["hi"][leaves[k]])
    for k in np.argsort(-reached.max(axis=0)):
        at = np.flatnonzero(~done[:, k] & (reached[:, k] > -np.inf) & (reached[:, k] >= kth()))
        if len(at):
            yield at, int(tree["lo"][leaves[k]]), int(tree["hi"][leaves[k]])


# --- integer inner products ------------------------------------------------

def scaled(v: np.ndarray) -> np.ndarray:
    """floor(64 * x); what would be infinite is the largest double."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(64.0 * v))


def _shard(ids: np.ndarray, vectors: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Ball tree over the different vectors; ``ids`` by vector, ascending."""
    dims = max(map(len, vectors))
    different, which = distinct_rows(matrix([scaled(v) for v in vectors], dims))
    order, tree = build(different)
    return {"dims": np.array([dims]), "x": different[order].ravel(), **grouped(ids, which, order), **tree,
            "centre": tree["centre"].ravel()}


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, which = np.unique(x, axis=0, return_inverse=True)
    return different, which.ravel()


def grouped(ids: np.ndarray, which: np.ndarray, order: np.ndarray) -> dict[str, np.ndarray]:
    """Ids by their vector's place in ``order``, ascending; ``repeat``: how
    often an id is found at most."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    counts = np.bincount(place[which], minlength=len(order))
    return {"ids": ids[np.lexsort((ids, place[which]))], "first": np.cumsum(counts) - counts, "count": counts,
            "repeat": np.unique(ids, return_counts=True)[1].max(keepdims=True)}


def load(path: str) -> dict[str, np.ndarray]:
    s = load_arrays(path)
    dims = int(s["dims"][0])
    return s | {"x": s["x"].reshape(-1, dims), "centre": s["centre"].reshape(-1, dims)}


def fit_dims(a: np.ndarray, dims: int) -> np.ndarray:
    """Columns cut or padded with zeros (what is cut meets only zeros)."""
    return a[:, :dims] if a.shape[1] >= dims else np.pad(a, ((0, 0), (0, dims - a.shape[1])))


def members(s: dict[str, np.ndarray], lo: int, hi: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, id) of rows lo to hi: of equal vectors the smallest ids, as many
    as can be among the best ``k`` beside a query's own."""
    count = np.minimum(s["count"][lo:hi], k + int(s["repeat"][0]))
    start = np.cumsum(count) - count
    at = np.arange(count.sum()) - np.repeat(start, count) + np.repeat(s["first"][lo:hi], count)
    return np.repeat(np.arange(hi - lo), count), s["ids"][at]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products as longs; beyond a long, the nearest one."""
    with np.errstate(over="ignore"):
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    least, greatest = -(1 << 63), (1 << 63) - 1
    left, right = ([list(map(int, r)) for r in m] for m in (a, b))
    exact = [[min(max(sum(map(int.__mul__, u, v)), least), greatest) for v in right] for u in left]
    return np.array(exact, np.int64).reshape(len(a), len(b))


def search(spark: SparkSession, queries: DataFrame, shards: list[str], find: Callable, score: str, k: int, label: str,
           block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries (id, vector).

    Queries are dealt to block files; a task takes a block through a group of
    shards: ``find(ids, vectors, paths)`` gives its :class:`TopK`.
    """
    base = scratch_path(spark, f"{label}-queries")
    rows = materialize(spark, queries.select("id", "vector").withColumn("uid", F.monotonically_increasing_id()), label)
    blocks = max(1, -(-rows.count() // block))

    def write(part: pa.Table) -> pa.Table:
        path = unique_file(base, "block", ".bin")
        vectors = [np.array(v, np.float64) for v in part.column("vector").to_pylist()]
        dims = max(map(len, vectors))
        save_arrays(path, {"id": part.column("id").to_numpy(), "uid": part.column("uid").to_numpy(),
                           "dims": np.array([dims]), "x": matrix(vectors, dims).ravel()})
        return pa.table({"path": [path]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    paths = materialize(spark, dealt.groupBy("block").applyInArrow(write, "path string"), f"{label}-blocks")
    groups = [shards[i:i + group] for i in range(0, len(shards), group)]
    empty = f"query_id long, rank int, vec_id long, score {score}"
    if not groups:
        return spark.createDataFrame([], empty)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, part in zip(f["path"], f["part"]):
                q = load_arrays(path)
                best = find(q["id"], q["x"].reshape(len(q["id"]), -1), groups[part])
                out = ranked(q["id"], best)
                out["uid"] = np.repeat(q["uid"], best.found)
                yield out

    tasks = paths.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))
    tasks = tasks.repartition(max(1, min(100_000, blocks * len(groups))))
    found = tasks.mapInPandas(run, f"query_id long, rank int, vec_id long, score {score}, uid long")
    by = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def exact_top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD,
                block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products
    of each query with the vectors of another id, ties to smaller ids.

    ``vectors`` and ``queries`` are (id, vector); components count as
    floor(64 * x), at most the largest double, and products beyond a long as the
    nearest long.  Rows with a null id, or a vector that is null, empty or with
    a null or non-finite component take no part; vectors of another length count
    as padded with zeros; repeated ids are several candidates.  No vector, or no
    query, gives no row.  Neither side is held whole by a task.
    """
    vectors = vectors.where(finite("vector") & F.col("id").isNotNull())
    queries = queries.where(finite("vector") & F.col("id").isNotNull())
    files = write_shards(spark, vectors.select("id", "vector"), "balltree", _shard, shard)

    def find(own: np.ndarray, x: np.ndarray, paths: list[str]) -> TopK:
        q = scaled(x)
        with np.errstate(over="ignore"):
            norm = np.sqrt((q * q).sum(axis=1))
        best = TopK(len(own), k, np.int64)
        for path in paths:
            s = load(path)
            here = fit_dims(q, s["x"].shape[1])

            def bound(nodes, rows, s=s, here=here):
                with np.errstate(over="ignore", invalid="ignore"):
                    b = here[rows] @ s["centre"][nodes].T + norm[rows, None] * s["radius"][nodes]
                    return np.nan_to_num(b + 1e-9 * np.abs(b) + 1e-6, nan=np.inf, posinf=np.inf)

            for rows, lo, hi in descend(s, bound, lambda: best.kth):
                place, ids = members(s, lo, hi, k)
                best.offer(rows, _products(here[rows], s["x"][lo:hi])[:, place], ids, own[rows])
        return best

    return search(spark, queries, [path for path, _ in files], find, "long", k, "balltree", block, group)


def ranked(own: np.ndarray, best: TopK) -> pd.DataFrame:
    row, rank = np.nonzero(np.arange(best.k)[None, :] < best.found[:, None])
    return pd.DataFrame({"query_id": own[row], "rank": (rank + 1).astype(np.int32),
                         "vec_id": best.id[row, rank], "score": best.score[row, rank]})
