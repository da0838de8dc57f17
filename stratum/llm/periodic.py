"""Periodic runs of words, by seeds and extended diagonals.

A run is a stretch of words with smallest period q and a length of at least
``max(SHORTEST, EXPONENT * q)`` that no neighbouring word extends.  On the
diagonal of lag q (words i and i + q are equal) it covers its length less q:
at least (EXPONENT - 1) * q words.  Lags are taken in classes [a, 1.5 a);
a class indexes the k-grams of its minimum guaranteed overlap, k = 3a (5 words
for lag 1, 6 for lag 2), within a document.

Of the occurrences of a k-gram only each and its next one are paired.  That
loses no run: if a k-gram inside the run came back after d < q words, it would
have the periods d and q, d + q <= k, hence their greatest common divisor, and
the run a smaller period.  So the next occurrence is q words on, and pairs stay
as many as positions however often a word repeats.  For each lag a
furthest-covered mark suppresses seeds that an extension has passed already.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import binaries, fresh, slices

#: A run's least length in words, and in periods.
SHORTEST = 6
EXPONENT = 4
#: Shortest seed: the diagonal of a run of period 1.
SEED_WORDS = 5

_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)

RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def lag_classes(most: int) -> list[tuple[int, int, int]]:
    """(least lag, greatest lag, k) up to lag ``most``; twice the greatest lag
    is at most k."""
    out, a = [], 1
    while a <= most:
        b = max(a, (3 * a - 1) // 2)
        out.append((a, min(b, most), max(SEED_WORDS, 6 if a == 2 else 0, (EXPONENT - 1) * a)))
        a = b + 1
    return out


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + b
    x = (x ^ (x >> _U(29))) * _B
    return x ^ (x >> _U(32))


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k-gram, from those of its first and last 2^j words."""
    h, size = _joined(ids.astype(_U), _U(0)), 1
    while 2 * size <= k:
        h, size = _joined(h[:-size], h[size:]), 2 * size
    return h if size == k else _joined(h[:len(h) - (k - size)], h[k - size:])


def next_same(values: np.ndarray) -> np.ndarray:
    """Of each place the next one with the same value; -1 without one."""
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    out = np.full(len(values), -1, np.int64)
    out[order[:-1][same]] = order[1:][same]
    return out


def _reach(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on (step 1), or before it (step -1), equal
    those ``lag`` words further on."""
    n = len(ids) - lag - at if step > 0 else at
    done, size = 0, 16
    while done < n:
        size = min(size, n - done)
        a = at + done if step > 0 else at - done - size
        differ = ids[a:a + size] != ids[a + lag:a + lag + size]
        if differ.any():
            return done + int((differ if step > 0 else differ[::-1]).argmax())
        done, size = done + size, 2 * size
    return done


def runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a document's word numbers, by
    start, then period.

    ``longest``: words that the longest stretch of repeated ``SEED_WORDS``-grams
    covers, where known; longer diagonals needn't be looked for.
    """
    n, found = len(ids), []
    most = n // EXPONENT
    if longest is not None:
        most = min(most, max(1, longest // (EXPONENT - 1)))
    if n < SHORTEST:
        return found
    for least, greatest, k in lag_classes(most):
        if k + least > n:
            break
        after = next_same(gram_hashes(ids, k))
        lag = after - np.arange(len(after))
        covered: dict[int, int] = {}
        for at in np.flatnonzero((after >= 0) & (lag >= least) & (lag <= greatest)).tolist():
            q = int(lag[at])
            if at < covered.get(q, 0):
                continue
            right = _reach(ids, at, q, 1)
            if right < k:
                continue  # equal hashes of different words
            start = at - _reach(ids, at, q, -1)
            covered[q] = at + right
            length = at + right + q - start
            if length >= max(SHORTEST, EXPONENT * q):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def best(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; ties to the smallest
    start, then period."""
    top = None
    for run in found:  # in that order already
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return top


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    stays = np.ones(n, bool)
    for start, length, q in found:
        stays[start + q:start + length] = False
    return stays


def planted(n: int, h: int) -> np.ndarray | None:
    """The word numbers of a document whose tail is made periodic, by the hash
    of its id; None where it stays as it is."""
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _stretches(repeats: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Of each document the longest stretch of places that are marked."""
    edge = np.flatnonzero(np.diff(np.r_[0, repeats.view(np.int8), 0]))
    lo, hi = edge[::2], edge[1::2]
    out = np.zeros(n_docs, np.int64)
    np.maximum.at(out, doc[lo], hi - lo)
    return out


def describe(texts: list[bytes | None], hashes: list[int | None]) -> list[tuple]:
    """A result row for each text; ``hashes``: of the ids, to plant periodic
    tails by, or None."""
    words = [(t or b"").split() for t in texts]  # white space of bytes: 0x09-0x0D and 0x20
    numbers: dict[bytes, int] = {}
    ids = []
    for ws, h in zip(words, hashes):
        row = np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws))
        source = planted(len(ws), h) if h is not None else None
        ids.append((row if source is None else row[source], source))
    # one index of the shortest seeds for all these documents, divided by words of their own
    sizes = np.array([len(r) for r, _ in ids], np.int64)
    doc = np.repeat(np.arange(len(ids)), sizes + 1)
    every = np.full(len(doc), -1, np.int64)
    inside = np.ones(len(doc), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    every[inside] = np.concatenate([r for r, _ in ids]) if ids else []
    every[~inside] = -1 - np.arange(len(ids))
    longest = np.zeros(len(ids), np.int64)
    if len(every) > SEED_WORDS:
        seeds = _joined(gram_hashes(every, SEED_WORDS), doc[:1 - SEED_WORDS].astype(_U))
        longest = _stretches(next_same(seeds) >= 0, doc, len(ids))
    out = []
    for ws, (row, source), stretch in zip(words, ids, longest.tolist()):
        found = runs(row, stretch + SEED_WORDS - 1) if stretch else []
        top = best(found)
        stays = kept(len(row), found) if found else None
        if source is None and stays is None:
            left = ws
        else:
            at = source if source is not None else np.arange(len(ws))
            left = [ws[i] for i in (at if stays is None else at[stays]).tolist()]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
        out.append((len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                    hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """``docs`` with all columns and a digest of each text's periodic runs (the
    columns of ``RESULT``; names that ``docs`` has get an underscore).

    ``start``, ``length``, ``period`` and ``exponent_milli`` (1000 * length /
    period, rounded down) are those of the run of the greatest exponent and null
    without a run; ``runs_sha256`` is of all runs, ``collapsed_sha256`` of the
    text without the words that repeat a run's first period.  ``plant`` makes
    the tails of a tenth of the documents periodic first, by their ids (for
    tests and benchmarks); a null id is planted nothing.

    Words are compared exactly, as UTF-8 bytes.  Null, empty and blank texts
    have no word; repeated rows and ids give repeated rows; an empty table
    gives none.  A document is one row of a map: nothing is shuffled, and a
    text's memory is a few numbers for each of its words.
    """
    at, by = docs.columns.index(text), docs.columns.index(id_col)
    names, typed = [], docs
    for column in RESULT.split(", "):
        name, kind = column.split()
        names.append(fresh(typed, name))
        typed = typed.withColumn(names[-1], F.lit(None).cast(kind))
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            hashes = [zlib.crc32(str(i).encode()) if plant and i is not None else None for i in b.column(by).to_pylist()]
            rows = describe(binaries(b.column(at)), hashes)
            new = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, *names])

    return docs.mapInArrow(run, typed.schema)


def listed_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row (id, start, length, period) for each run of each document."""
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, start long, length long, period long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            owner, rows = [], []
            for i, t in enumerate(binaries(b.column(1))):
                numbers: dict[bytes, int] = {}
                words = (t or b"").split()
                found = runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
                owner += [i] * len(found)
                rows += found
            ids = b.column(0).take(pa.array(owner, pa.int64()))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([ids, *columns], [id_col, "start", "length", "period"])

    return docs.select(id_col, text).mapInArrow(run, schema)
