"""Approximate nearest neighbours by stable projections and a chi-square test.

Unit vectors are projected on a few Gaussian directions.  For two vectors at
squared distance d2, the squared projected distance is d2 times a chi-square
variable of as many degrees as there are directions.  Each shard holds a
kd-tree of the projected points.  A query visits its boxes from the nearest on,
verifies points by their true cosine, and stops when the next projected
distance is so large that a point as near as the kth found would be that far
off with a probability of 1 - ``confidence`` at most.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from stratum.llm.balltree import (TopK, descend, distinct_rows, finite, fit_dims, grouped, matrix, members, search,
                                  write_shards)
from stratum.llm.common import load_arrays

K = 5
DIRECTIONS = 8
CONFIDENCE = 0.98
SHARD = 16_384
LEAF = 64
BLOCK = 512
GROUP = 8
SEED = 20


def chi_square_quantile(p: float, degrees: int) -> float:
    """x with P(chi-square <= x) = p, for an even number of degrees."""
    def cdf(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def directions(dims: int, count: int = DIRECTIONS, seed: int = SEED) -> np.ndarray:
    """[dims, count]; more dimensions add rows and change none."""
    return np.random.default_rng(seed).normal(size=(dims, count))


def build(p: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """kd-tree over projected points: order of the rows, and of each node the
    rows ``lo`` to ``hi``, the first child ``left`` (-1: leaf) and its box."""
    order = np.arange(len(p))
    lo, hi, left, least, most = [0], [len(p)], [-1], [], []
    at = 0
    while at < len(lo):
        rows = order[lo[at]:hi[at]]
        part = p[rows]
        least.append(part.min(axis=0))
        most.append(part.max(axis=0))
        axis = int((most[-1] - least[-1]).argmax())
        if len(rows) > leaf and most[-1][axis] > least[-1][axis]:
            mid = len(rows) // 2
            order[lo[at]:hi[at]] = rows[np.argpartition(part[:, axis], mid)]
            left[at] = len(lo)
            lo += [lo[at], lo[at] + mid]
            hi += [lo[at] + mid, hi[at]]
            left += [-1, -1]
        at += 1
    return order, {"lo": np.array(lo), "hi": np.array(hi), "left": np.array(left),
                   "least": np.array(least), "most": np.array(most)}


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs of rows; the same vectors give the same bits.  Rows are first
    scaled by powers of two, which changes no digit, so squares stay in range."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _shard(count: int, seed: int):
    def make(ids: np.ndarray, vectors: list[np.ndarray]) -> dict[str, np.ndarray]:
        dims = max(map(len, vectors))
        x, which = distinct_rows(matrix(vectors, dims))
        p = _unit(x) @ directions(dims, count, seed)
        order, tree = build(p)
        return {"dims": np.array([dims]), "x": x[order].ravel(), "p": p[order].ravel(), **grouped(ids, which, order),
                **tree, "least": tree["least"].ravel(), "most": tree["most"].ravel()}
    return make


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = K,
            confidence: float = CONFIDENCE, count: int = DIRECTIONS, shard: int = SHARD, block: int = BLOCK,
            group: int = GROUP, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query the ``k`` vectors of
    another id with the largest cosine that are found, ties to smaller ids.
    ``score`` is the cosine of the original vectors in double precision.

    ``vectors`` and ``queries`` are (id, vector).  Every vector is indexed;
    there is no cap on what is verified.  A true neighbour is missed with a
    probability of at most 1 - ``confidence``.  Rows with a null id, or a
    vector that is null, empty, zero or with a null or non-finite component
    take no part; vectors of another length count as padded with zeros; of
    equal vectors those with the smallest ids are given; an empty side gives
    no row.
    """
    nonzero = "exists(vector, x -> x <> 0)"
    vectors = vectors.where(finite("vector")).where(nonzero).where("id IS NOT NULL")
    queries = queries.where(finite("vector")).where(nonzero).where("id IS NOT NULL")
    files = write_shards(spark, vectors.select("id", "vector"), "projections", _shard(count, seed), shard)
    factor = chi_square_quantile(confidence, count)

    def find(own: np.ndarray, q: np.ndarray, paths: list[str]) -> TopK:
        u, dims = _unit(q), q.shape[1]
        near = u @ directions(dims, count, seed)
        best = TopK(len(own), k, np.float64)
        for path in paths:
            s = load_arrays(path)
            wide = int(s["dims"][0])
            s |= {n: s[n].reshape(-1, count) for n in ("p", "least", "most")} | {"x": s["x"].reshape(-1, wide)}
            size = max(wide, dims)
            full = fit_dims(q, size)

            def bound(nodes, rows, s=s):
                out = np.zeros((len(rows), len(nodes)))
                for j in range(count):
                    low, high = s["least"][nodes, j], s["most"][nodes, j]
                    gap = np.maximum(np.maximum(low - near[rows, j, None], near[rows, j, None] - high), 0)
                    out += gap * gap
                return 1 - out / (2 * factor) + 1e-9

            for rows, lo, hi in descend(s, bound, lambda: best.kth):
                p, x = s["p"][lo:hi], fit_dims(s["x"][lo:hi], size)
                gap = ((near[rows] ** 2).sum(axis=1)[:, None] + (p ** 2).sum(axis=1) - 2 * near[rows] @ p.T)
                kth = best.kth[rows][:, None]
                about = fit_dims(u, size)[rows] @ _unit(x).T
                a, b = np.nonzero((1 - gap / (2 * factor) + 1e-9 >= kth) & (about >= kth - 1e-9))
                score = np.full(about.shape, -np.inf)
                score[a, b] = cosines(full[rows[a]], x[b])
                place, ids = members(s, lo, hi, k)
                best.offer(rows, score[:, place], ids, own[rows])
        return best

    return search(spark, queries, [path for path, _ in files], find, "double", k, "projections", block, group)
