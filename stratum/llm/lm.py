"""n-gram language model in an Elias-Fano trie of memory-mapped levels.

Level 1 is the vocabulary: words in the order of a 64-bit hash, so a word's id
is its rank.  Level n holds the n-grams as one ascending sequence of
``context rank * width + relative id``: the rank of the first n-1 words in
level n-1, and the place of the last word among the successors of the words
between (for bigrams: its id).  An n-gram is found by one successor search of
that number; its place in the sequence is its rank for the next level.  Each
node has a monotone pointer to its first successor.  Counts are kept as their
running sum, also monotone, discounted probabilities and back-off weights as
16-bit logarithms.

Smoothing is interpolated absolute discounting down to add-0.1 unigrams, with
one place for unknown words; every n-gram seen is kept.  Every level is counted, cut and written by Spark: tasks send sorted
blocks of numbers with counts for each shard, a shard merges its blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import binaries, load_arrays, materialize, save_arrays, slices, unique_file
from stratum.llm.eliasfano import EliasFano
from stratum.session import scratch_path

ORDER = 3
ADD = 0.1
#: n-grams of order 2 and more are kept from this count on: all of them.
LEAST = 1
#: Tokens that a task counts, or scores, at a time; tokens for each shard of a level.
CHUNK = 1 << 19
SHARD = 1 << 21
#: A quantised logarithm q stands for 10 ** (-q / STEPS).
STEPS = 3000.0

_U = np.uint64
_END = _U(xxhash.xxh64_intdigest(b"\n"))  # no word has white space


def hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of a text's words and, after them, of the end."""
    words = (text or b"").lower().split()
    out = np.empty(len(words) + 1, _U)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    out[-1] = _END
    return out


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.clip(np.rint(-np.log10(np.maximum(p, 0)) * STEPS), 0, 65535).astype(np.uint16)


def restored(q: np.ndarray) -> np.ndarray:
    """65535 stands for zero."""
    return np.where(q == 65535, 0.0, 10.0 ** (-q.astype(float) / STEPS))


# --- counts of numbers, as compact blocks ----------------------------------

def _block(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts: differences, byte by byte, compressed."""
    gaps = np.diff(keys, prepend=_U(0))
    raw = gaps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(keys).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unblock(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(pa.decompress(data[4:], 12 * n, codec="zstd", asbytes=True), np.uint8)
    gaps = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view(_U).ravel()
    return np.cumsum(gaps, dtype=_U), np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view("<u4").ravel()


def _counted(keys: np.ndarray, shard_of: Callable[[np.ndarray], np.ndarray], rows: list) -> None:
    """Append (shard, block) rows of the different keys; shards ascend with keys."""
    different, counts = np.unique(keys, return_counts=True)
    if not len(different):
        return
    shard = shard_of(different)
    cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
    rows += [(int(shard[a]), _block(different[a:b], counts[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]


_BLOCKS = "shard int, block binary"
_SHARDS = "shard int, path string, n long, total long, once long, twice long"


def _blocks(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], ["shard", "block"])


def _merge(base: str, level: int):
    """Merge a shard's blocks and write its file: ``keys`` (level 1: hashes as
    they are; else Elias-Fano above the least one) and running counts."""
    def run(group: pa.Table) -> pa.Table:
        parts = [_unblock(b) for b in group.column("block").to_pylist()]
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[first], np.add.reduceat(counts.astype(np.int64), first)
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        if level > 1:
            keys, counts = keys[counts >= LEAST], counts[counts >= LEAST]
        path = unique_file(base, f"level{level}", ".bin")
        total = np.r_[0, np.cumsum(counts)]
        arrays = {"first": keys[:1]} | EliasFano.of(total).arrays("total")
        arrays |= {"keys": keys} if level == 1 else EliasFano.of(keys - (keys[0] if len(keys) else _U(0))).arrays("keys")
        save_arrays(path, arrays)
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "path": [path], "n": [len(keys)],
                         "total": [int(total[-1])], "once": [once], "twice": [twice]})
    return run


# --- levels ------------------------------------------------------------------

@functools.lru_cache(maxsize=4096)
def _mapped(path: str) -> dict[str, np.ndarray]:
    return load_arrays(path)


@functools.lru_cache(maxsize=4096)
def _sequence(path: str, name: str) -> EliasFano:
    return EliasFano.load(_mapped(path), name)


@dataclass
class Level:
    """``files``: (path, n, total) of the shards in key order; ``width``: the
    number a context rank is multiplied by; ``nodes``, ``probs``: files with
    pointers and back-offs, and with discounted probabilities, by shard."""

    number: int
    files: list[tuple[str, int, int]]
    discount: float = 0.0
    width: int = 1
    nodes: list[str] = field(default_factory=list)
    probs: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.starts = np.cumsum([0] + [n for _, n, _ in self.files])
        self.before = np.cumsum([0] + [t for _, _, t in self.files])

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    @functools.cached_property
    def firsts(self) -> np.ndarray:
        return np.concatenate([_mapped(p)["first"] for p, _, _ in self.files] or [np.zeros(0, _U)])

    def _by_shard(self, where: np.ndarray):
        """(shard, slice) for ascending shard numbers."""
        cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True]) if len(where) else np.zeros(1, int)
        return [(int(where[a]), slice(a, b)) for a, b in zip(cuts[:-1], cuts[1:])]

    def successor(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the first n-grams not below the (ascending) keys, and
        whether they are those."""
        where = np.maximum(np.searchsorted(self.firsts, keys, "right") - 1, 0)
        rank, same = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        if not len(self.files):
            return rank, same
        for shard, at in self._by_shard(where):
            path = self.files[shard][0]
            if self.number == 1:
                own = _mapped(path)["keys"]
                i = np.searchsorted(own, keys[at])
                ok = own[np.minimum(i, len(own) - 1)] == keys[at]
                ok &= i < len(own)
            else:
                low = self.firsts[shard]
                i, ok = _sequence(path, "keys").successor(keys[at] - np.minimum(low, keys[at]))
                ok &= keys[at] >= low
            rank[at], same[at] = i + self.starts[shard], ok
        return rank, same

    def bounds(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the first n-grams not below the (ascending) keys, and the
        counts of all n-grams before them; for so many keys that shards are
        better unpacked whole, one at a time."""
        rank, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(self.files):
            return rank, total
        for shard, at in self._by_shard(np.maximum(np.searchsorted(self.firsts, keys, "right") - 1, 0)):
            path, low = self.files[shard][0], self.firsts[shard]
            i = np.searchsorted(_sequence(path, "keys").values(), keys[at] - np.minimum(low, keys[at]))
            rank[at] = i + self.starts[shard]
            total[at] = _sequence(path, "total").values().astype(np.int64)[i] + self.before[shard]
        return rank, total

    def find(self, keys: np.ndarray) -> np.ndarray:
        rank, same = self.successor(keys)
        return np.where(same, rank, -1)

    def _gather(self, ranks: np.ndarray, get, dtype) -> np.ndarray:
        out = np.zeros(len(ranks), dtype)
        where = np.searchsorted(self.starts, ranks, "right") - 1
        for shard, at in self._by_shard(where):
            out[at] = get(shard, ranks[at] - self.starts[shard])
        return out

    def totals(self, ranks: np.ndarray) -> np.ndarray:
        """Counts of all n-grams before the (ascending) ranks."""
        last = ranks >= self.size
        out = np.full(len(ranks), self.before[-1])
        out[~last] = self._gather(ranks[~last], lambda s, i: _sequence(self.files[s][0], "total").access(i).astype(
            np.int64) + self.before[s], np.int64)
        return out

    def counts(self, ranks: np.ndarray) -> np.ndarray:
        def get(s, i):
            seq = _sequence(self.files[s][0], "total")
            return seq.access(i + 1).astype(np.int64) - seq.access(i).astype(np.int64)
        return self._gather(ranks, get, np.int64)

    def pointers(self, ranks: np.ndarray) -> np.ndarray:
        return self._gather(ranks, lambda s, i: _sequence(self.nodes[s], "pointer").access(i).astype(np.int64)
                            + _mapped(self.nodes[s])["base"][0], np.int64)

    def backoffs(self, ranks: np.ndarray) -> np.ndarray:
        return restored(self._gather(ranks, lambda s, i: _mapped(self.nodes[s])["backoff"][i], np.uint16))

    def discounted(self, ranks: np.ndarray) -> np.ndarray:
        return restored(self._gather(ranks, lambda s, i: _mapped(self.probs[s])["prob"][i], np.uint16))


class Looked:
    """What is known of the n-grams at some places: the different ones looked up
    once, in ascending order, for all that is asked about them."""

    def __init__(self, values: np.ndarray, valid: np.ndarray, find: Callable[[np.ndarray], np.ndarray] | None = None):
        self.valid = valid
        different, self.inverse = np.unique(values[valid], return_inverse=True)
        self.ranks = find(different) if find else different
        self.known = self.ranks >= 0
        self.rank = self.of(lambda r: r, -1, np.int64)

    def of(self, fn: Callable[[np.ndarray], np.ndarray], fill, dtype) -> np.ndarray:
        """``fn`` of the ranks, by place; ``fill`` where there is none."""
        own = np.full(len(self.ranks), fill, dtype)
        if self.known.any():
            own[self.known] = fn(self.ranks[self.known])
        out = np.full(len(self.valid), fill, dtype)
        out[self.valid] = own[self.inverse]
        return out


def _ascending(values: np.ndarray, fn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``fn`` of each of some ascending values."""
    new = np.r_[True, values[1:] != values[:-1]]
    return fn(values[new])[np.cumsum(new) - 1]


def _shifted(values: np.ndarray, fill) -> np.ndarray:
    """Each place's value at the next one."""
    return np.r_[np.array([fill], values.dtype), values[:-1]]


@dataclass
class Model:
    levels: list[Level]
    tokens: int  # training tokens, ends included
    end: int  # id of the end

    @property
    def words(self) -> int:
        return self.levels[0].size

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.tokens + ADD * (self.words + 1))

    def keys(self, n: int, below: list[Looked]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the n-gram that ends at each place, and where there
        can be one.  ``below[k]``: the (k+1)-grams that end there.  Texts follow
        one another; each starts after an end, which is the only context of its
        first word."""
        level, last = self.levels[n - 1], below[n - 2].rank
        context = self.context(n, below)
        valid = (context >= 0) & (last >= 0)
        relative = last
        if n > 2:
            relative = last - _shifted(below[n - 3].of(self.levels[n - 3].pointers, 0, np.int64), 0)
        keys = np.zeros(len(last), _U)
        keys[valid] = context[valid].astype(_U) * _U(level.width) + relative[valid].astype(_U)
        return keys, valid

    def context(self, n: int, below: list[Looked]) -> np.ndarray:
        """Rank of the n-1 words before each place, -1 without."""
        out = _shifted(below[n - 2].rank, -1)
        if n > 2:
            out[np.r_[True, below[0].rank[:-1] == self.end]] = -1
        return out

    def look(self, ids: np.ndarray, upto: int) -> list[Looked]:
        """For orders 1 to ``upto`` the n-grams at each place."""
        out = [Looked(ids, ids >= 0)]
        for n in range(2, upto + 1):
            out.append(Looked(*self.keys(n, out), self.levels[n - 1].find))
        return out

    def probabilities(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(model, base) probability of each place of texts laid end to end,
        the first place being an end before the first text."""
        grams = self.look(ids, len(self.levels))
        base = self.unigram(grams[0].of(self.levels[0].counts, 0, np.int64))
        p = base.copy()
        for n in range(2, len(self.levels) + 1):
            back = _shifted(grams[n - 2].of(self.levels[n - 2].backoffs, 1.0, float), 1.0)
            back[self.context(n, grams) < 0] = 1.0
            p = grams[n - 1].of(self.levels[n - 1].discounted, 0.0, float) + back * p
        return p, base


# --- building ----------------------------------------------------------------

def _chunks(docs: Iterator[np.ndarray], size: int = CHUNK) -> Iterator[np.ndarray]:
    """Arrays laid end to end, ``size`` items or a little more at a time (an
    array beyond that alone)."""
    held, n = [], 0
    for d in docs:
        held.append(d)
        n += len(d)
        if n >= size:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _collect(frame: DataFrame) -> list:
    """A row for each shard."""
    return sorted(frame.collect(), key=lambda r: r.shard)


def _vocabulary(spark: SparkSession, docs: DataFrame, base: str, shards: int) -> Level:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for b in slices(batches, 0) for t in binaries(b.column(0)))
        for chunk in _chunks(map(hashes, texts)):
            rows: list = []
            _counted(chunk, lambda k: ((k >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64), rows)
            yield _blocks(rows)

    merged = docs.select("text").mapInArrow(run, _BLOCKS).groupBy("shard").applyInArrow(_merge(base, 1), _SHARDS)
    return Level(1, [(r.path, r.n, r.total) for r in _collect(merged)])


def _arrays(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(x, np.int32) for x in column.to_pylist())


def _identified(docs: DataFrame, level: Level) -> DataFrame:
    """(doc_id, text, held_out) -> (doc_id, held_out, ids): 32-bit ids of the
    words and the end, -1 where unknown."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            texts = [hashes(t) for t in binaries(b.column(2))]
            all_ = np.concatenate(texts)
            ids = Looked(all_, np.ones(len(all_), bool), level.find).rank.astype(np.int32)
            parts = np.split(ids, np.cumsum([len(t) for t in texts])[:-1])
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array([p.tobytes() for p in parts], pa.binary())],
                                             ["doc_id", "held_out", "ids"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, ids binary")


def _count_level(spark: SparkSession, ids: DataFrame, model: Model, n: int, base: str, shards: int) -> Level:
    """Count the n-grams of ``ids`` and write their level.  Shards are cut by
    the running count of contexts and the relative id, so a frequent context
    is divided over shards and all have about the same tokens."""
    below, width = model.levels[n - 2], model.levels[n - 1].width
    share = max(1, int(below.before[-1]))

    def shard_of(keys):
        context, relative = (keys // _U(width)).astype(np.int64), keys % _U(width)
        start, count = _ascending(context, below.totals), _ascending(context, below.counts)
        place = start + count * (relative / float(width))
        return np.minimum((place * (shards / share)).astype(np.int64), shards - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (x for b in batches for x in _arrays(b.column(0)))
        for chunk in _chunks(texts):
            rows: list = []
            keys, valid = model.keys(n, model.look(np.r_[model.end, chunk].astype(np.int64), n - 1))
            _counted(keys[valid], shard_of, rows)
            if rows:
                yield _blocks(rows)

    merged = ids.select("ids").mapInArrow(run, _BLOCKS).groupBy("shard").applyInArrow(_merge(base, n), _SHARDS)
    rows = _collect(merged)
    once, twice = sum(r.once for r in rows), sum(r.twice for r in rows)
    # the discount that absolute discounting takes from each n-gram's count
    discount = once / (once + 2 * twice) if once and twice else 0.5
    return Level(n, [(r.path, r.n, r.total) for r in rows if r.n], discount, width)


def _finish(spark: SparkSession, model: Model, n: int, base: str) -> None:
    """Write level n's discounted probabilities, and the pointers and back-offs
    of level n-1, shard by shard; sets the width of the level after."""
    upper, lower = model.levels[n - 1], model.levels[n - 2]

    def probs(shard: int) -> tuple[str, int]:
        path, size, _ = upper.files[shard]
        keys = _sequence(path, "keys").values() + upper.firsts[shard]
        context = (keys // _U(upper.width)).astype(np.int64)
        counts = np.diff(_sequence(path, "total").values().astype(np.int64))
        own = (counts - upper.discount) / _ascending(context, lower.counts)
        out = unique_file(base, f"probs{n}", ".bin")
        save_arrays(out, {"prob": quantised(own)})
        return out, 0

    def nodes(shard: int) -> tuple[str, int]:
        path, size, _ = lower.files[shard]
        ranks = np.arange(size + 1) + lower.starts[shard]
        pointer, totals = upper.bounds(ranks.astype(_U) * _U(upper.width))
        inside = np.diff(totals) - upper.discount * np.diff(pointer)
        # an end is a context as often as it is counted: before each text
        count = np.diff(_sequence(path, "total").values().astype(np.int64))
        out = unique_file(base, f"nodes{n - 1}", ".bin")
        save_arrays(out, {"base": pointer[:1], "backoff": quantised(np.maximum(1 - inside / count, 1e-12))}
                    | EliasFano.of(pointer - pointer[0]).arrays("pointer"))
        return out, int(np.diff(pointer).max(initial=0))

    jobs = [("probs", i) for i in range(len(upper.files))] + [("nodes", i) for i in range(len(lower.files))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for kind, i in f.itertuples(index=False):
                path, most = (probs if kind == "probs" else nodes)(int(i))
                yield pd.DataFrame([(kind, i, path, most)], columns=["kind", "shard", "path", "most"])

    dealt = spark.createDataFrame(jobs, "kind string, shard int").repartition(len(jobs), "kind", "shard")
    done = dealt.mapInPandas(run, "kind string, shard int, path string, most long").collect()
    files = {(r.kind, r.shard): r.path for r in done}
    upper.probs = [files["probs", i] for i in range(len(upper.files))]
    lower.nodes = [files["nodes", i] for i in range(len(lower.files))]
    if n < len(model.levels):
        model.levels[n].width = max(r.most for r in done) + 1


def _scored(ids: DataFrame, model: Model) -> DataFrame:
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2, 4 * CHUNK):
            texts = list(_arrays(b.column(2)))
            sizes = np.array([len(t) for t in texts])
            flat = np.concatenate([[model.end], *texts]).astype(np.int64)
            p, base = model.probabilities(flat)
            at = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array(sizes, pa.int64()),
                 *[pa.array(np.add.reduceat(x[1:], at)) for x in ((flat >= 0).astype(np.int64), np.log10(base), np.log10(p))]],
                [c.split()[0] for c in schema.split(", ")])

    return ids.mapInArrow(run, schema)


def train_and_score(spark: SparkSession, docs: DataFrame, held_out: Column, order: int = ORDER,
                    shard: int = SHARD) -> DataFrame:
    """Train on the rows of ``docs`` (doc_id, text) that aren't ``held_out`` and
    score all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score.  ASCII letters are lower-cased; a text's tokens are its words and
    one end.

    ``base_score`` is the add-0.1 unigrams', exact; ``score`` the model's
    log10 probability, within the quantising step of 1/3000 a token.  A null or
    empty text is one end; null ids and repeated rows are scored like others;
    an empty table gives no row; without training rows every token is unknown
    and alike.  Two words with the same 64-bit hash would count as one.
    The widest numbers, context rank times width, must fit 64 bits.
    """
    base = scratch_path(spark, "lm")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where("NOT held_out")
    size = train.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-size // (6 * shard)))  # words have about six bytes
    vocabulary = _vocabulary(spark, train, base, shards)
    end = vocabulary.find(np.array([_END]))[0] if vocabulary.files else -1
    model = Model([vocabulary], int(vocabulary.before[-1]), int(end))
    if model.words >= 1 << 31:
        raise OverflowError("more than 2**31 words: ids need more than 32 bits")
    ids = materialize(spark, _identified(rows, vocabulary), "lm-ids")
    if model.words:
        model.levels += [Level(n, [], 0.0, model.words if n == 2 else 1) for n in range(2, order + 1)]
        shards = max(least, -(-model.tokens // shard))
        for n in range(2, order + 1):
            if model.levels[n - 2].size * model.levels[n - 1].width >= 1 << 63:
                raise OverflowError(f"numbers of {n}-grams need more than 63 bits")
            model.levels[n - 1] = _count_level(spark, ids.where("NOT held_out"), model, n, base, shards)
            _finish(spark, model, n, base)
    scored = _scored(ids, model)
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
