"""SimHash near-duplicate classes by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  Of two fingerprints
that differ in at most two bits, the low segments differ in at most one bit,
or else the high segments are equal.  So the 32 low segments with one bit
taken out, and the whole high segment, are index keys of which any such two
share one; equal keys meet in one sorted run, where the bit distance is
verified.  Only different fingerprints are indexed: copies are one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import binaries, fresh, materialize, slices, spanning
from stratum.llm.components import components

SHINGLE = 3
MAX_BITS = 2
#: Runs up to this many fingerprints are compared pair by pair, lag by lag.
LAGS = 64
#: Runs up to this many (512 KB) are held by a task; larger ones are handed on
#: as rows to :func:`_wide_links`.
RUN_LIMIT = 1 << 16

_LOW = (1 << 32) - 1
_ONE = np.uint64(1)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text's word shingles (null or no word: zero)."""
    words = (text or b"").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    grams = ([b" ".join(words)] if len(words) < shingle
             else map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h)).view(np.uint64)[0])


def with_fingerprint(df: DataFrame, shingle: int = SHINGLE, text: str = "text", name: str = "fp") -> DataFrame:
    """All rows and columns of ``df`` and the fingerprint of ``text`` as a long."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            fps = np.array([fingerprint(t, shingle) for t in binaries(b.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))], [*b.schema.names, name])

    return df.mapInArrow(run, df.select("*", F.lit(0).cast("long").alias(name)).schema)


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): 33 index keys for each fingerprint; a key's upper half is the
    number of the bit left out (32: none, the high segment)."""
    return (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("b"))
            .select(F.expr(f"""
                CASE WHEN b = 32 THEN shiftrightunsigned(fp, 32)
                     ELSE fp & {_LOW}L & ~shiftleft(1L, b) END + shiftleft(cast(b AS bigint), 32)
                """).alias("key"), "fp"))


def _first_key(x: np.ndarray) -> np.ndarray:
    """The smallest key number that two fingerprints of difference ``x`` share."""
    low = x & np.uint64(_LOW)
    ones = np.bitwise_count(low)
    bit = np.bitwise_count((low & (~low + _ONE)) - _ONE)
    return np.where(ones == 0, 0, np.where(ones == 1, bit, 32))


def _masks(low: bool, most: int) -> np.ndarray:
    bits = [_ONE << np.uint64(i + 32 * (not low)) for i in range(32)]
    return np.array([np.bitwise_or.reduce(np.array(c, np.uint64)) for n in range(1, most + 1)
                     for c in combinations(bits, n)], np.uint64)


def _probed(run: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within a long run by looking up each member's neighbours: linear
    in the run, whatever its density."""
    if number == 32:
        masks = _masks(True, 2)[32:]
    else:
        own = _ONE << np.uint64(number)
        masks = np.concatenate([np.array([own]), _masks(False, 1) | own])
        if number == 0:
            masks = np.concatenate([_masks(False, 2), masks])
    run = np.sort(run)
    parts_a, parts_b = [], []
    for m in masks:
        near = run ^ m
        at = np.searchsorted(run, near)
        at[at == len(run)] = 0
        hit = (run[at] == near) & (near > run)
        parts_a.append(run[hit])
        parts_b.append(near[hit])
    return spanning(np.concatenate(parts_a), np.concatenate(parts_b))


def _links_of(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the whole runs of equal keys (sorted)."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    found = []
    for at in np.flatnonzero(sizes > LAGS):
        run = slice(starts[at], starts[at] + sizes[at])
        found.append(_probed(fps[run], int(keys[starts[at]] >> 32)))
    small = np.repeat(sizes <= LAGS, sizes)
    k, f = keys[small], fps[small]
    for lag in range(1, int(sizes[sizes <= LAGS].max(initial=1))):
        at = np.flatnonzero(k[lag:] == k[:-lag])
        x = f[at] ^ f[at + lag]
        ok = (np.bitwise_count(x) <= MAX_BITS) & (_first_key(x) == k[at] >> 32)
        found.append((f[at[ok]], f[at[ok] + lag]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return spanning(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))


_FOUND = "u long, v long, wide boolean"


def _rows(u: np.ndarray, v: np.ndarray, wide: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)),
                                       pa.array(np.full(len(u), wide))], ["u", "v", "wide"])


def _search(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        wide = None  # key of a run that is too long to hold

        def close(keys, fps):
            return _rows(*_links_of(keys, fps), False)

        for b in batches:
            keys = np.concatenate([keys, b.column(0).to_numpy()])
            fps = np.concatenate([fps, b.column(1).to_numpy().view(np.uint64)])
            if wide is not None:
                n = int(np.searchsorted(keys, wide, "right"))
                yield _rows(fps[:n], keys[:n].view(np.uint64), True)
                keys, fps = keys[n:], fps[n:]
            if not len(keys):
                continue
            wide = None
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield close(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if len(keys) > limit:
                wide = keys[0]
                yield _rows(fps, keys.view(np.uint64), True)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield close(keys, fps)

    return run


def _wide_links(wide: DataFrame) -> DataFrame:
    """Links of runs too long for a task.  All fingerprints that agree but for
    two fixed bits differ in at most two bits from each other, so each such
    group is linked by a star: (u, v), v the group's least.  The pairs of bits
    are those whose pairs of fingerprints the run answers for."""
    rows = wide.select(F.col("u").alias("fp"), F.expr("cast(shiftrightunsigned(v, 32) AS int)").alias("b"))
    high = "transform(sequence(32, 63), k -> shiftleft(1L, k))"
    pair = "flatten(transform({0}, (x, i) -> transform(slice({0}, i + 2, 32), y -> x | y)))"
    low = "transform(sequence(0, 31), k -> shiftleft(1L, k))"
    masks = F.expr(f"""CASE WHEN b = 32 THEN {pair.format(low)}
        WHEN b = 0 THEN concat(transform({high}, k -> k | 1L), {pair.format(high)})
        ELSE transform({high}, k -> k | shiftleft(1L, b)) END""")
    cut = (rows.select("fp", F.explode(masks).alias("mask"))
           .select("fp", "mask", F.expr("fp & ~mask").alias("rest")))
    least = cut.groupBy("mask", "rest").agg(F.min("fp").alias("v"))
    return cut.join(least, ["mask", "rest"]).where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def fingerprint_classes(spark: SparkSession, fps: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Different fingerprints ``fp`` -> (fp, root): the class under links of at
    most two differing bits.  A class's root is one of its fingerprints."""
    found = (variants(fps).repartition("key").sortWithinPartitions("key", "fp")
             .mapInArrow(_search(run_limit), _FOUND))
    found = materialize(spark, found, "simhash-links")
    links = found.where("NOT wide").select("u", "v")
    wide = found.where("wide")
    if not wide.isEmpty():
        links = links.unionByName(_wide_links(wide))
    return fps.join(components(spark, links).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE,
                    run_limit: int = RUN_LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex
    digits), component_id (smallest doc_id reachable over links of at most two
    differing bits, itself included).

    A null or empty text, or one of white space, has fingerprint zero and is
    linked like any other; fewer words than a shingle are one shingle.  Null
    ids never become a component_id unless a class has no other.  Repeated
    rows give repeated rows; an empty table gives none.  Other columns of
    ``docs`` are ignored.
    """
    rows = materialize(spark, with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"),
                       "simhash-fps")
    least = materialize(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    classes = fingerprint_classes(spark, least.select("fp"), run_limit).join(least, "fp")
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each class: the least (doc_id, fingerprint),
    nulls last; of repeated rows, one."""
    uid, fp = fresh(docs, "uid"), fresh(docs, "fp")
    rows = with_fingerprint(docs.withColumn(uid, F.monotonically_increasing_id()), shingle, name=fp)
    rows = materialize(spark, rows, "simhash-docs")
    pick = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col(fp).alias("fp"),
                    F.col(uid).alias("uid"))
    least = materialize(spark, rows.groupBy(F.col(fp).alias("fp")).agg(F.min(pick).alias("pick")),
                        "simhash-distinct")
    best = (fingerprint_classes(spark, least.select("fp")).join(least, "fp")
            .groupBy("root").agg(F.min("pick").alias("pick")).select(F.col("pick.uid").alias(uid)))
    return rows.join(best, uid, "left_semi").select(*docs.columns)
