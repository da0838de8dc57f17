"""Packing token sequences by shortest-pack-first over the length histogram.

Documents are cut into pieces of at most the sequence length.  Only the
histogram of piece lengths reaches the driver (one count for each length);
there patterns of lengths are built, longest length first, each put into the
pack with the most room.  A pattern is a list of lengths and how many sequences
have it.  Pieces then find their place by their rank among those of their
length.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import materialize, slices

LENGTH = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"

#: Chunks a worker process remembers.
_CACHED = 400_000


class Encoder:
    """Ids of whole texts by the tokenizer, remembering the ids of words.

    The tokenizer's own pattern always splits before a single space or line
    feed that stands between other characters that are no white space.  So in
    texts with single ones only, a word is encoded on its own with the same
    result: with the space before it, or (key with a NUL) without, after a
    line feed.  Other texts are encoded whole.  Arrow splits the texts and
    finds the different words, so a word is looked up once for many texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._feed = self._encode(["\n"])[0][0]
        self._of: dict[str, int] = {"\n": 0}
        self._ids, self._end = np.full(1 << 20, self._feed, np.uint32), 1
        self._first, self._size = np.zeros(1 << 14, np.int64), np.ones(1 << 14, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str], keep: bool):
        """Words are encoded on their own, many in one call.  Their places
        follow those of the words remembered; without ``keep`` they count for
        the texts at hand only."""
        lines = [k[1:] if k[0] == "\0" else " " + k for k in keys]
        found = [e.ids for e in self._tok.encode_batch_fast(lines, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        kept = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum()))
        at, end = len(self._of), self._end + len(kept)
        while end > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while at + len(sizes) > len(self._size):
            self._first, self._size = (np.concatenate([x, np.zeros_like(x)]) for x in (self._first, self._size))
        self._ids[self._end:end] = kept
        self._first[at:at + len(sizes)] = self._end + np.cumsum(sizes) - sizes
        self._size[at:at + len(sizes)] = sizes
        if keep:
            self._end = end
            self._of.update(zip(keys, range(at, at + len(sizes))))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and "\0" not in t and len(" ".join(t.split())) == len(t)]
        if plain:
            split = pc.split_pattern(pa.array(["\0" + texts[i].replace("\n", " \n \0") for i in plain], pa.large_string()), " ")
            words = split.flatten().dictionary_encode()
            keys = words.dictionary.to_numpy(zero_copy_only=False).tolist()
            place = np.fromiter(map(self._of.get, keys, itertools.repeat(-1)), np.int64, len(keys))
            missing = np.flatnonzero(place < 0)
            long = np.array([len(keys[k]) > 200 for k in missing], bool)  # not worth remembering
            new = [keys[k] for k in missing[~long]]
            place[missing[~long]] = len(self._of) + np.arange(len(new))
            if new:  # what came early is frequent
                self._learn(new, len(self._of) + len(new) <= _CACHED)
            which = place[words.indices.to_numpy()]
            ends = split.offsets.to_numpy()
            whole = np.logical_or.reduceat(which < 0, ends[:-1])  # a text has a word at least
            size = np.where(which < 0, 0, self._size[which])
            last = np.cumsum(size)
            ids = self._ids[np.arange(last[-1]) + np.repeat(self._first[which] - last + size, size)]
            for i, w, at, end in zip(plain, whole, (last - size)[ends[:-1]].tolist(), last[ends[1:] - 1].tolist()):
                if not w:
                    out[i] = ids[at:end]
        rest = [i for i in range(len(texts)) if out[i] is None]
        for i, ids in zip(rest, self._encode([texts[i] for i in rest])):
            out[i] = ids
        return out


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    return Encoder(path)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, nth long"


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, text) -> a row for each piece: whole sequences, then what is
    left.  ``task`` and ``nth``: the task and how many pieces of this length it
    made before; write the rows before using these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        encoder, made, task = _encoder(str(path)), np.zeros(length + 1, np.int64), TaskContext.get().partitionId()
        for b in slices(batches, 1):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.ids([t or "" for t in b.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for at in range(0, len(ids), length):
                    part = ids[at:at + length]
                    rows.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids), task,
                                 int(made[len(part)])))
                    made[len(part)] += 1
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             [c.split()[0] for c in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, number of sequences) from a histogram of lengths.

    Lengths go from the longest to the shortest.  Packs are grouped by pattern
    and kept by the room left; pieces of a length go into the packs with the
    most room, all packs of a pattern at once, and into new packs when the
    roomiest has too little.  Ties go to the pattern that came first.
    """
    by_room: dict[int, list[list]] = {}
    roomy = np.zeros(length + 1, bool)

    def put(pattern, count, room):
        by_room.setdefault(room, []).append([pattern, count])
        roomy[room] = True

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            rooms = np.flatnonzero(roomy[size:])
            if not len(rooms):
                each = length // size  # a new pack has the most room until it is full
                full, rest = divmod(left, each)
                if full:
                    put((size,) * each, full, length - each * size)
                if rest:
                    put((size,) * rest, 1, length - rest * size)
                break
            room = int(rooms[-1]) + size
            group = by_room[room]
            pattern, count = group[0]
            n = min(left, count)
            if n == count:
                group.pop(0)
                roomy[room] = bool(group)
            else:
                group[0][1] = count - n
            put((*pattern, size), n, room - size)
            left -= n
    return [(p, n) for room in sorted(by_room) for p, n in by_room[room]]


def _places(patterns: list[tuple[tuple[int, ...], int]], length: int) -> dict[str, np.ndarray]:
    """For each length, in order of rank: where ranks from ``first`` on go."""
    rows, sequence = [], 0
    used = dict.fromkeys(range(length + 1), 0)
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rows.append((size, used[size], sequence, offset))
            used[size] += count
            offset += size
        sequence += count
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": (a[:, 0] << 48) + a[:, 1], "first": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3]}


def pack(spark: SparkSession, docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text): doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone; null ids and repeated rows are
    documents like others; an empty table has no piece; other columns play no
    part.  The tokenizer's special strings in a text are ordinary text.
    Ranks need no sort: a piece's rank is the number of pieces of its length
    in earlier tasks (a running sum over tasks) and before it in its own task.
    """
    made = materialize(spark, pieces(docs, length, tokenizer), "packing-pieces")
    counts = materialize(spark, made.groupBy("length", "task").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(shortest_pack_first(histogram, length), length)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = made.join(base, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank"))
    shared = spark.sparkContext.broadcast(places)  # a few entries for each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for b in batches:
            size, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            k = np.searchsorted(at["key"], (size << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(at["sequence"][k] + rank - at["first"][k]), pa.array(at["offset"][k])],
                [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long")
