"""Hard negatives from lists that clusters of anchors share.

Anchors are clustered by direction.  For a cluster with centre c, whose members
lie within an angle w of it, no member's product with a candidate x exceeds
``|member| * |x| * cos(max(0, angle(x, c) - w))``.  Candidates are sorted by
that bound once for the cluster; every member walks the same list from its head
and leaves it once the bound at the next place is certified to be too low.

Candidates lie in shard files, anchors in block files (a part of a cluster);
a task takes one block through one group of shards, so its input does not grow
with the tables.  Spark merges the groups' best.  There are two walks: one for
the positives, whose scores set the windows in which the second looks for the
negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.balltree import finite, fit_dims, matrix
from stratum.llm.common import load_arrays, materialize, save_arrays, unique_file
from stratum.session import scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score that a negative has, at least and at most.
LOW, HIGH = 30, 90
#: Candidates of a shard file, shards of a task, anchors of a block.
SHARD = 16_384
GROUP = 8
BLOCK = 256
#: Anchors that the clusters are fitted on, and clusters at most.
SAMPLE = 4_096
CLUSTERS = 256
#: Places of a shared list that are scored at a time.
STRIDE = 512

_EXACT = float(1 << 52)  # sums below this are exact in doubles
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def scaled(vectors: list[np.ndarray], scale: int = SCALE) -> np.ndarray:
    """floor(scale * x); what would be infinite is the largest double."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        x = np.floor(scale * matrix(vectors, max(map(len, vectors))))
    return np.clip(x, -most, most)


def lengths(x: np.ndarray) -> np.ndarray:
    """Norms of rows; infinite only where they don't fit a double."""
    top = np.abs(x).max(axis=1, initial=0)
    safe = np.where(top > 0, top, 1)[:, None]
    with np.errstate(over="ignore"):
        return top * np.sqrt(((x / safe) ** 2).sum(axis=1))


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    top = np.abs(x).max(axis=1, initial=0)
    x = x / np.where(top > 0, top, 1)[:, None]
    n = np.sqrt((x * x).sum(axis=1))
    return x / np.where(n > 0, n, 1)[:, None]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products as longs; beyond a long, the nearest one."""
    with np.errstate(over="ignore"):
        most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    left, right = [[list(map(int, r)) for r in m] for m in (a, b)]
    exact = [[min(max(sum(map(int.__mul__, u, v)), _LEAST), _MOST) for v in right] for u in left]
    return np.array(exact, np.int64).reshape(len(a), len(b))


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest score of a negative: ``low * score <= 100 * s <= high * score``."""
    return max(-(-low * score // 100), _LEAST), min(high * score // 100, _MOST)


def centres(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Directions of ``count`` clusters at most (spherical k-means)."""
    u = np.unique(units(x), axis=0)
    c = u[np.linspace(0, len(u) - 1, min(count, len(u))).astype(int)]
    for _ in range(rounds):
        near = (u @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        c = np.where(np.abs(total).sum(axis=1, keepdims=True) > 0, units(total), c)
    return c


class Best:
    """The best ``k`` (score, id) of each row, ties to smaller ids."""

    def __init__(self, rows: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.astype(np.int64).copy()
        self.row, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size, self.rows = 0, rows

    def offer(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.kth[row]
        if good.any():
            self.waiting.append((row[good], score[good], ids[good]))
            self.size += int(good.sum())
            if self.size > 4 * self.k * self.rows:
                self.settle()

    def settle(self) -> None:
        """Keep ``k`` of each row; their last score is what others must reach."""
        if not self.waiting:
            return
        row, score, ids = (np.concatenate(x) for x in zip((self.row, self.score, self.id), *self.waiting))
        self.waiting, self.size = [], 0
        order = np.lexsort((ids, ~score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.searchsorted(row, np.arange(self.rows))
        rank = np.arange(len(row)) - first[row]
        last = rank == self.k - 1
        self.kth[row[last]] = np.maximum(self.kth[row[last]], score[last])
        self.row, self.score, self.id = (x[rank < self.k] for x in (row, score, ids))


# --- files -------------------------------------------------------------------

def _candidates(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> dict[str, np.ndarray]:
    """A shard: its different (label, vector), each with its ids ascending."""
    x = scaled(vectors)
    both, which = np.unique(np.c_[labels.astype(np.float64), x], axis=0, return_inverse=True)
    which = which.ravel()
    count = np.bincount(which, minlength=len(both))
    x = np.ascontiguousarray(both[:, 1:])
    return {"dims": np.array([x.shape[1]]), "x": x.ravel(), "unit": units(x).ravel(), "norm": lengths(x),
            "label": both[:, 0].astype(np.int64), "ids": ids[np.lexsort((ids, which))],
            "first": np.cumsum(count) - count, "count": count,
            "repeat": np.unique(ids, return_counts=True)[1].max(keepdims=True)}


def _block(uids: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> dict[str, np.ndarray]:
    """A block of anchors, its centre and the angle that holds all of them."""
    x = scaled(vectors)
    u, norm = units(x), lengths(x)
    centre = units(u.sum(axis=0, keepdims=True))
    away = np.arccos(np.clip(u[norm > 0] @ centre[0], -1, 1))
    wide = np.array([away.max(initial=0) if np.abs(centre).any() else np.pi])
    return {"dims": np.array([x.shape[1]]), "x": x.ravel(), "norm": norm, "uid": uids, "id": ids, "label": labels,
            "centre": centre[0], "wide": wide}


def _load(path: str) -> dict[str, np.ndarray]:
    s = load_arrays(path)
    dims = int(s["dims"][0])
    return s | {n: s[n].reshape(-1, dims) for n in ("x", "unit") if n in s}


def write_shards(spark: SparkSession, rows: DataFrame, size: int = SHARD) -> list[str]:
    """Deal (id, label, vector) row by row to files of about ``size``; a
    frequent id, label or vector fills no shard."""
    base = scratch_path(spark, "negatives-shards")
    dealt = materialize(spark, rows.withColumn("at", F.monotonically_increasing_id()), "negatives-rows")
    shards = max(1, -(-dealt.count() // size))

    def write(group: pa.Table) -> pa.Table:
        path = unique_file(base, "shard", ".bin")
        ids, labels = (group.column(n).to_numpy() for n in ("id", "label"))
        save_arrays(path, _candidates(ids, labels, [np.array(v, np.float64) for v in group.column("vector").to_pylist()]))
        return pa.table({"path": [path]})

    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(shards))).drop("at")
    return [r.path for r in dealt.groupBy("shard").applyInArrow(write, "path string").collect()]


def write_blocks(spark: SparkSession, anchors: DataFrame, block: int = BLOCK, sample: int = SAMPLE,
                 clusters: int = CLUSTERS) -> DataFrame:
    """(path): (uid, id, label, vector) of anchors in files of about ``block``
    of one cluster.  Clusters are fitted on ``sample`` anchors, all are
    assigned; a larger cluster is dealt to several blocks."""
    base = scratch_path(spark, "negatives-blocks")
    chosen = anchors.orderBy(F.xxhash64("id", "uid")).limit(sample).select("vector").collect()
    if not chosen:
        return spark.createDataFrame([], "path string")
    total = anchors.count()
    c = centres(scaled([np.array(r.vector, np.float64) for r in chosen]), max(1, min(clusters, -(-total // block))))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                u = units(scaled([np.asarray(v, np.float64) for v in f["vector"]]))
                dims = max(u.shape[1], c.shape[1])
                f["cluster"] = (fit_dims(u, dims) @ fit_dims(c, dims).T).argmax(axis=1)
                yield f

    named = materialize(spark, anchors.mapInPandas(
        assign, "uid long, id long, label long, vector array<double>, cluster long"), "negatives-anchors")
    sizes = {r.cluster: r["count"] for r in named.groupBy("cluster").count().collect()}  # at most ``clusters`` rows
    parts = F.create_map(*[F.lit(x).cast("long") for k, n in sizes.items() for x in (k, -(-n // block))])
    dealt = named.withColumn("part", F.pmod(F.xxhash64("uid"), parts[F.col("cluster")]))

    def write(group: pa.Table) -> pa.Table:
        path = unique_file(base, "block", ".bin")
        uids, ids, labels = (group.column(n).to_numpy() for n in ("uid", "id", "label"))
        save_arrays(path, _block(uids, ids, labels, [np.array(v, np.float64) for v in group.column("vector").to_pylist()]))
        return pa.table({"path": [path]})

    return materialize(spark, dealt.groupBy("cluster", "part").applyInArrow(write, "path string"), "negatives-paths")


# --- walks -------------------------------------------------------------------

def shared_list(s: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A shard's places by falling bound for a block, and those bounds for an
    anchor of length one."""
    dims = max(s["unit"].shape[1], len(b["centre"]))
    off = np.arccos(np.clip(fit_dims(s["unit"], dims) @ fit_dims(b["centre"][None], dims)[0], -1, 1))
    fits = np.isfinite(s["norm"])  # longer ones are at the head of every list
    norm = np.where(fits, s["norm"], 0)
    upper = np.where(fits, norm * np.cos(np.maximum(0, off - b["wide"][0] - 1e-6)) + 1e-9 * norm, np.inf)
    order = np.argsort(-upper, kind="stable")
    return order, upper[order]


def walk(s: dict[str, np.ndarray], b: dict[str, np.ndarray], needed, k: int, stride: int = STRIDE):
    """Members of block ``b`` along their shared list of shard ``s``: yields
    (members, scores [members, candidates], labels, place of each candidate's
    row, its id).  ``needed()``: the score that a candidate must reach, by
    member; those whose bound is below it have left the list for good."""
    order, upper = shared_list(s, b)
    dims = max(b["x"].shape[1], s["x"].shape[1])
    mine = fit_dims(b["x"], dims)
    on = np.arange(len(mine))
    for at in range(0, len(order), stride):
        with np.errstate(over="ignore", invalid="ignore"):
            reach = np.nan_to_num(b["norm"][on] * upper[at], nan=np.inf, posinf=np.inf)
        on = on[reach + 1e-6 >= needed()[on]]
        if not len(on):
            return
        places = order[at:at + stride]
        # of equal vectors the smallest ids, as many as can be among the best beside an anchor's own
        count = np.minimum(s["count"][places], k + int(s["repeat"][0]))
        column = np.repeat(np.arange(len(places)), count)
        offset = np.arange(len(column)) - np.repeat(np.cumsum(count) - count, count)
        ids = s["ids"][s["first"][places][column] + offset]
        yield on, products(mine[on], fit_dims(s["x"][places], dims)), s["label"][places], column, ids


def _positives(b: dict[str, np.ndarray], paths: list[str], k: int, stride: int = STRIDE) -> Best:
    best = Best(len(b["id"]), k, np.full(len(b["id"]), _LEAST))

    def needed() -> np.ndarray:
        best.settle()
        return best.kth

    for path in paths:
        for on, scores, labels, column, ids in walk(_load(path), b, needed, k, stride):
            row, at = np.nonzero((labels[None, :] == b["label"][on, None])[:, column])
            other = ids[at] != b["id"][on[row]]
            row, at = row[other], at[other]
            best.offer(on[row], scores[row, column[at]], ids[at])
    best.settle()
    return best


def _negatives(b: dict[str, np.ndarray], owner: np.ndarray, low: np.ndarray, high: np.ndarray, paths: list[str],
               k: int, stride: int = STRIDE) -> Best:
    """For pairs of a member (``owner``) and a window of scores."""
    best = Best(len(owner), k, low)

    def needed() -> np.ndarray:
        best.settle()
        least = np.full(len(b["id"]), _MOST)
        np.minimum.at(least, owner, np.where(low <= high, best.kth, _MOST))
        return least

    for path in paths:
        for on, scores, labels, column, ids in walk(_load(path), b, needed, k, stride):
            line = np.full(len(b["id"]), -1)
            line[on] = np.arange(len(on))
            pairs = np.flatnonzero(line[owner] >= 0)
            at_line = line[owner[pairs]]
            mine = scores[at_line]
            good = ((labels[None, :] != b["label"][owner[pairs], None]) & (mine >= best.kth[pairs, None])
                    & (mine <= high[pairs, None]))
            row, at = np.nonzero(good[:, column])
            best.offer(pairs[row], mine[row, column[at]], ids[at])
    best.settle()
    return best


def mine(spark: SparkSession, rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, shard: int = SHARD, block: int = BLOCK,
         group: int = GROUP, stride: int = STRIDE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (id, label, vector); components count as
    floor(256 * x) and scores are exact integer inner products (beyond a long:
    the nearest long).  An anchor's positives are its best ``positives`` rows
    of the same label and another id, its negatives for one of them the best
    ``negatives`` rows of other labels with ``low * positive_score <= 100 *
    negative_score <= high * positive_score``; ties go to smaller ids.

    Rows with a null id or label, or a vector that is null, empty or with a
    null or non-finite component take no part; shorter vectors count as padded
    with zeros; repeated rows are several candidates and several anchors; a
    zero anchor's scores are all 0.  An anchor without a positive, or a pair
    without a negative, gives no row, nor does an empty side.
    """
    columns = [F.col("id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>")]
    rows, anchors = (df.where(finite("vector") & F.col("id").isNotNull() & F.col("label").isNotNull()).select(*columns)
                     for df in (rows, anchors))
    anchors = materialize(spark, anchors.withColumn("uid", F.monotonically_increasing_id()), "negatives-own")
    shards = write_shards(spark, rows, shard)
    blocks = write_blocks(spark, anchors.select("uid", "id", "label", "vector"), block)
    groups = [shards[i:i + group] for i in range(0, len(shards), group)]
    if not groups:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")

    def tasks(paths: DataFrame) -> DataFrame:
        """A row and a partition for each block and group of shards."""
        pairs = paths.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))
        return pairs.repartition(max(1, min(100_000, paths.count() * len(groups))))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, part in zip(f["path"], f["part"]):
                b = _load(path)
                best = _positives(b, groups[part], positives, stride)
                yield pd.DataFrame({"block": path, "uid": b["uid"][best.row], "id": best.id, "score": best.score})

    def second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, part, pairs in zip(f["path"], f["part"], f["pairs"]):
                b = _load(path)
                place = {u: i for i, u in enumerate(b["uid"].tolist())}
                owner = np.array([place[p["uid"]] for p in pairs], np.int64)
                limits = [window(int(p["score"]), low, high) for p in pairs]
                best = _negatives(b, owner, *(np.array(x, np.int64) for x in zip(*limits)), groups[part], negatives, stride)
                yield pd.DataFrame({"anchor_id": b["id"][owner[best.row]], "uid": b["uid"][owner[best.row]],
                                    "place": np.array([p["rank"] for p in pairs])[best.row],
                                    "positive_id": np.array([p["id"] for p in pairs])[best.row],
                                    "positive_score": np.array([p["score"] for p in pairs])[best.row],
                                    "negative_id": best.id, "negative_score": best.score})

    def leading(df: DataFrame, keys: list[str], ident: str, score: str, k: int) -> DataFrame:
        by = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
        return df.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    found = tasks(blocks).mapInPandas(first, "block string, uid long, id long, score long")
    # a repeated row's places are told apart by their rank
    found = leading(found, ["block", "uid"], "id", "score", positives)
    pairs = found.groupBy(F.col("block").alias("path")).agg(
        F.collect_list(F.struct("uid", "id", "score", "rank")).alias("pairs"))  # a block's anchors times ``positives``
    pairs = materialize(spark, pairs, "negatives-pairs")
    out = tasks(pairs).mapInPandas(
        second, "anchor_id long, uid long, place int, positive_id long, positive_score long, negative_id long, "
                "negative_score long")
    out = leading(out, ["uid", "place"], "negative_id", "negative_score", negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
