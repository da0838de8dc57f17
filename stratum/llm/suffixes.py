"""Removal of repeated byte strings by blockwise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
in the corpus.  Every place with that many bytes behind it starts a window, a
suffix cut at ``length``; equal windows are neighbours in suffix order.

*Blocks.*  A window is named by the smallest hash of its 16-byte grams (its
anchor), so equal windows meet in the same shard, and consecutive windows share
an anchor: a segment of text carries some forty windows for their bytes and 99
more.  Grams that are very frequent in the corpus are smaller than no other, so
a line of a third of all documents names only windows that lie wholly in such
text.  Anchors found once in the corpus hold no repeat; only segments of others
are shuffled, and of equal segments of a chunk of documents only the first.

*Suffix sorting.*  In a shard, ranks are precomputed for the suffixes at a
difference cover: for any two places some shift under ``COVER`` takes both to
ranked ones.  Windows are then sorted one bucket of leading bytes at a time, by
``COVER`` bytes only; longer ties are resolved by the ranks at the shift of the
two places.  Memory is that of a bucket and of one rank for each place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import binaries, filesystem, fresh, materialize, numbered, packed, unpacked
from stratum.session import scratch_path

LENGTH = 100
GRAM = 16
#: Modulus of the difference cover: bytes that a sort compares itself.
COVER = 32
#: Windows of a segment at most; bytes that are hashed at a time; bytes of text
#: of a chunk and of a shard; windows of a bucket.
SEGMENT = 256
PIECE = 1 << 18
CHUNK = 16_000_000
SHARD_BYTES = 8_000_000
BUCKET = 1_000_000

_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_FREQUENT = _U(1 << 63)  # set in the value of a frequent gram


# --- anchors -----------------------------------------------------------------

def _places(data: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes at every place, as a view."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - width + 1, width), (1, 1))


def gram_values(data: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A value for each gram: a hash with the lowest bit free, and the highest
    bit set if it is in ``frequent`` (sorted)."""
    n = len(data) - GRAM + 1
    words = np.ascontiguousarray(_places(data, 8)).view(_U).ravel()
    h = words[:n] * _M1
    h ^= h >> _U(31)
    h += words[8:n + 8]
    h *= _M2
    h ^= h >> _U(29)
    h *= _M1
    h >>= _U(2)
    h <<= _U(1)
    if len(frequent):
        some = np.zeros(1 << 16, bool)
        some[(frequent >> _U(1)).astype(np.int64) & 0xFFFF] = True
        at = np.flatnonzero(some[(h >> _U(1)).astype(np.int64) & 0xFFFF])
        at = at[np.isin(h[at], frequent)]
        h[at] |= _FREQUENT
    return h


def _sliding(extreme: np.ufunc, h: np.ndarray, width: int) -> np.ndarray:
    """The minimum or maximum of ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        h, size = extreme(h[:-size], h[size:]), 2 * size
    return h if size == width else extreme(h[:len(h) - (width - size)], h[width - size:])


def segments(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int = LENGTH,
             frequent: np.ndarray = np.empty(0, _U)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor, whether the anchor stands there
    more than once) of the runs of windows with one anchor, in texts that lie at
    ``starts`` to ``stops`` of ``data``.  Equal windows of one segment have the
    anchor at different places."""
    found, width = [], length - GRAM + 1
    edge = np.zeros(len(data) + 1, np.int8)
    fits = stops - starts >= length
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, stops[fits] - length + 1, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    for at in range(0, max(len(data) - length + 1, 0), PIECE):
        part = data[at:at + PIECE + length - 1]
        values = gram_values(part, frequent)
        least = _sliding(np.minimum, values, width)
        here = inside[at:at + len(least)]
        cut = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (here[1:] != here[:-1])])
        count = np.diff(np.r_[cut, len(least)])
        cut, count = cut[here[cut]], count[here[cut]]
        # places that are the anchor of some window, and how many of them are a segment's own
        spot = np.flatnonzero(values == _sliding(np.maximum, np.pad(least, width - 1), width))
        low, high = np.searchsorted(spot, cut), np.searchsorted(spot, cut + count + width - 1)
        run = np.repeat(np.arange(len(cut)), high - low)
        near = spot[np.repeat(low, high - low) + np.arange(len(run)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
        own = np.bincount(run[values[near] == least[cut][run]], minlength=len(cut))
        found.append((cut + at, count, least[cut], own > 1))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U), np.empty(0, bool)
    first, count, tag, many = (np.concatenate(x) for x in zip(*found))
    parts = -(-count // SEGMENT)  # long runs (periodic text) in pieces
    owner = np.repeat(np.arange(len(first)), parts)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    return first[owner] + k * SEGMENT, np.minimum(count[owner] - k * SEGMENT, SEGMENT), tag[owner], many[owner]


# --- suffix order of a shard ---------------------------------------------------

def difference_cover(v: int = COVER) -> np.ndarray:
    """Residues such that every difference modulo ``v`` is one of two of them:
    each time the one that adds most differences."""
    chosen = [0]
    have = {0}
    while len(have) < v:
        gains = {r: {(r - c) % v for c in chosen} | {(c - r) % v for c in chosen} for r in range(v)}
        r = max(gains, key=lambda x: (len(gains[x] - have), -x))
        chosen.append(r)
        have |= gains[r]
    return np.array(sorted(chosen))


def shifts(v: int = COVER) -> np.ndarray:
    """[v, v]: the least shift that takes both residues into the cover."""
    cover = np.zeros(v, bool)
    cover[difference_cover(v)] = True
    both = np.array([[[cover[(i + d) % v] and cover[(j + d) % v] for d in range(v)] for j in range(v)] for i in range(v)])
    return both.argmax(axis=2)


_SHIFT = shifts()
_COVERED = np.zeros(COVER, bool)
_COVERED[difference_cover()] = True


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at these places, as numbers in their order."""
    return _places(data, 8)[at].view(">u8").ravel().astype(_U)


def _split(act: np.ndarray, rank: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal rank (``act`` in the order of ranks) sorted by ``key``
    and divided: ranks are numbered anew in place.  (places in order, their keys, sizes of their groups)."""
    old = rank[act]
    order = np.lexsort((key, old)) if len(old) and old[0] != old[-1] else np.argsort(key, kind="stable")
    act, key = act[order], key[order]
    old = rank[act]
    at = np.arange(len(act))
    begins = np.r_[True, old[1:] != old[:-1]]
    divides = begins | np.r_[True, key[1:] != key[:-1]]
    was, now = (np.maximum.accumulate(np.where(x, at, 0)) for x in (begins, divides))
    rank[act] = old + now - was
    size = np.diff(np.r_[np.flatnonzero(divides), len(act)])
    return act, key, np.repeat(size, size)


def refine(data: np.ndarray, at: np.ndarray, depth: int, stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the suffixes at places ``at`` by ``depth`` bytes (what lies
    behind ``stop`` counts as zeros), and which are tied with others."""
    rank, act = np.zeros(len(at), np.int64), np.arange(len(at))
    for o in range(0, depth, 8):
        if not len(act):
            break
        if stop is None:
            key = _words(data, at[act] + o)
        else:
            left = np.clip(stop[act] - at[act] - o, 0, 8)
            key = _words(data, np.minimum(at[act] + o, len(data) - 8))
            gone = (8 * (8 - left)).astype(_U)
            key = np.where(left > 0, key >> gone % _U(64) << gone % _U(64), _U(0))
        act, _, size = _split(act, rank, key)
        act = act[size > 1]
    return rank, act


def cover_ranks(data: np.ndarray, first: np.ndarray, count: np.ndarray, stop: np.ndarray, length: int) -> np.ndarray:
    """A rank for every place of the difference cover that a window's shift can
    reach, others -1."""
    reach = count + COVER - 1
    owner = np.repeat(np.arange(len(first)), reach)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(reach) - reach, reach)
    keep = _COVERED[at % COVER]
    at, owner = at[keep], owner[keep]
    out = np.full(len(data), -1, np.int32)
    out[at] = refine(data, at, length, stop[owner])[0]
    return out


def _resolve(at: np.ndarray, rank: np.ndarray, act: np.ndarray, cover: np.ndarray) -> None:
    """Ties of ``COVER`` bytes, divided by cover ranks: every group is compared
    with one of its own, at the shift of the two places, until it's all equal."""
    while len(act):
        r = rank[act]
        begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        size = np.diff(np.r_[begin, len(act)])
        pivot = np.repeat(at[act[begin + size // 2]], size)
        shift = _SHIFT[at[act] % COVER, pivot % COVER]
        key = np.sign(cover[at[act] + shift].astype(np.int64) - cover[pivot + shift])
        act, key, size = _split(act, rank, key)
        act = act[(size > 1) & (key != 0)]


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of places hold the same ``length`` bytes."""
    same = np.ones(len(a), bool)
    for o in [*range(0, length - 7, 8), max(length - 8, 0)]:
        on = np.flatnonzero(same)
        if length >= 8:
            same[on] = _words(data, a[on] + o) == _words(data, b[on] + o)
        else:
            same[on] = (_places(data, length)[a[on]] == _places(data, length)[b[on]]).all(axis=1)
    return same


def repeated_windows(data: np.ndarray, first: np.ndarray, count: np.ndarray, length: int = LENGTH,
                     bucket: int = BUCKET) -> np.ndarray:
    """Of the windows of all segments, in their order: is there an equal one
    before?  Segments lie at ``first`` and hold ``count`` windows each; ``data``
    has ``COVER + 8`` bytes behind the last at least."""
    owner = np.repeat(np.arange(len(first)), count)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    again = np.zeros(len(at), bool)
    if not len(at):
        return again
    cover = cover_ranks(data, first, count, first + count + length - 1, length)
    head = _words(data, at)
    # buckets of leading bytes; equal ones stay together
    splits = np.unique(np.sort(head[::max(1, len(head) // 65_536)])[::max(1, min(len(head), 65_536) * bucket // len(head))])
    which = np.searchsorted(splits, head, "right")
    for k in np.unique(which):
        mine = np.flatnonzero(which == k)
        places = at[mine]
        rank, tied = refine(data, places, COVER)
        _resolve(places, rank, tied, cover)
        order = tied[np.argsort(rank[tied], kind="stable")]
        if not len(order):
            continue
        new = np.r_[True, ~_same(data, places[order[1:]], places[order[:-1]], length)]
        begin = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(order, begin), np.diff(np.r_[begin, len(order)]))
        again[mine[order]] = order != least
    return again


# --- chunks of documents -------------------------------------------------------

class Chunk:
    """Some documents (order, id, file, row, text) in the order of the corpus."""

    def __init__(self, docs: list[tuple]):
        self.name = f"{docs[0][2] & (1 << 64) - 1:x}-{docs[0][3]}"
        docs = sorted(docs, key=lambda d: d[:4])
        self.none, self.ids, self.file, self.row = (np.array([d[k] for d in docs], np.int64) for k in range(4))
        sizes = np.array([len(d[4]) for d in docs], np.int64)
        self.stops = np.cumsum(sizes)
        self.starts = self.stops - sizes
        self.text = b"".join(d[4] for d in docs)
        self.data = np.frombuffer(self.text, np.uint8)


def chunks(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[Chunk]:
    """Rows (id, file, row, text) in chunks of about ``size`` bytes; texts
    shorter than ``length`` have no window.  The same rows in the same order
    give the same chunks."""
    held, n = [], 0
    for b in batches:
        ids, file, row = (b.column(k).to_pylist() for k in range(3))
        for i, f, r, text in zip(ids, file, row, binaries(b.column(3))):
            if text is None or len(text) < length:
                continue
            held.append((int(i is None), i or 0, f, r, text))
            n += len(text)
            if n >= size:
                yield Chunk(held)
                held, n = [], 0
    if held:
        yield Chunk(held)


def _shard_of(tags: np.ndarray, shards: int) -> np.ndarray:
    return (((tags * _M3) >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1]]) if len(order) else []
    for a, b in zip(cut, [*cut[1:], len(order)]):
        yield int(shard[order[a]]), order[a:b]


def _merged(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals that touch or overlap made one, for each owner."""
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    if not len(owner):
        return owner, start, stop
    far = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + owner * far)
    new = np.r_[True, start[1:] + owner[1:] * far > reach[:-1]]
    begin = np.flatnonzero(new)
    return owner[begin], start[begin], reach[np.r_[begin[1:], len(owner)] - 1] - owner[begin] * far


# --- the job -------------------------------------------------------------------

def _frequent(spark: SparkSession, rows: DataFrame, length: int, shards: int, size: int) -> np.ndarray:
    """Anchors that name over an eighth of a shard's share of all segments; at
    most 16 for each shard.  A chunk tells those over half of that share in it;
    none that is over it in the corpus is under it in every chunk."""
    share = 1 / (8 * shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, length, size):
            _, _, tag, _ = segments(c.data, c.starts, c.stops, length)
            values, n = np.unique(tag, return_counts=True)
            often = n >= max(2, share / 2 * len(tag))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(values[often].view(np.int64)), pa.nulls(1, pa.int64())]),
                                              pa.array(np.r_[n[often], len(tag)])], ["tag", "n"])

    told = materialize(spark, rows.mapInArrow(count, "tag long, n long"), "suffixes-frequent")
    total = told.where("tag IS NULL").agg(F.sum("n")).first()[0] or 0
    often = told.where("tag IS NOT NULL").groupBy("tag").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, share / 2 * total))
    return np.sort(np.array([r.tag for r in often.select("tag").collect()], np.int64).view(_U))


def _repeated_anchors(spark: SparkSession, rows: DataFrame, length: int, shards: int, size: int,
                      frequent: np.ndarray) -> str:
    """A folder with a file for each chunk: its anchors that the corpus has
    twice or more, sorted.  A chunk without any has no file."""
    base = scratch_path(spark, "suffixes-anchors")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, length, size):
            _, _, tag, many = segments(c.data, c.starts, c.stops, length, frequent)
            values, n = np.unique(np.r_[tag, tag[many]], return_counts=True)
            values |= (n > 1).astype(_U)  # the lowest bit: twice in this chunk
            parts = list(_by_shard(_shard_of(values & ~_U(1), shards)))
            yield pa.RecordBatch.from_pydict({"shard": pa.array([k for k, _ in parts], pa.int64()), "chunk": [c.name] * len(parts),
                                              "tags": pa.array([values[at].tobytes() for _, at in parts], pa.binary())})

    def join(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, _U) for x in group.column("tags").to_pylist()]
        told = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(told & ~_U(1), kind="stable")
        tag, owner, twice = told[order] & ~_U(1), owner[order], (told[order] & _U(1)).astype(bool)
        same = tag[1:] == tag[:-1]
        keep = np.r_[False, same] | np.r_[same, False] | twice
        names = group.column("chunk").to_pylist()
        found = [(names[k], tag[keep][at].tobytes()) for k, at in _by_shard(owner[keep])]
        return pa.table({"chunk": pa.array([k for k, _ in found], pa.string()),
                         "tags": pa.array([t for _, t in found], pa.binary())})

    def write(group: pa.Table) -> pa.Table:
        name = group.column("chunk")[0].as_py()
        tags = np.sort(np.concatenate([np.frombuffer(x, _U) for x in group.column("tags").to_pylist()]))
        fs, path = filesystem(base)
        fs.create_dir(path, recursive=True)
        passing = f"{path}/.{name}-{hashlib.md5(np.random.bytes(16)).hexdigest()}"
        with fs.open_output_stream(passing, compression=None) as out:
            out.write(tags.tobytes())
        fs.move(passing, f"{path}/{name}")  # attempts write the same; a reader sees a whole file
        return pa.table({"n": [len(tags)]})

    told = rows.mapInArrow(tell, "shard long, chunk string, tags binary")
    back = told.repartition(shards, "shard").groupBy("shard").applyInArrow(join, "chunk string, tags binary")
    back.groupBy("chunk").applyInArrow(write, "n long").agg(F.sum("n")).collect()
    return base


_SPANS = "file long, row long, start long, stop long"


def repeated_spans(spark: SparkSession, rows: DataFrame, length: int = LENGTH, chunk: int = CHUNK,
                   shard_bytes: int = SHARD_BYTES, bucket: int = BUCKET) -> DataFrame:
    """(file, row, start, stop): bytes of ``rows`` (id, file, row, text) covered
    by windows that start earlier too.  (file, row) must number the rows, the
    same ones each time ``rows`` is read.  Of a row several spans may touch."""
    if length < max(GRAM, COVER):
        raise ValueError(f"windows of {max(GRAM, COVER)} bytes at least")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    rows = rows.select("id", "file", "row", "text")
    frequent = _frequent(spark, rows, length, shards, chunk)
    base = _repeated_anchors(spark, rows, length, shards, chunk, frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(base)
        for c in chunks(batches, length, chunk):
            if fs.get_file_info(f"{path}/{c.name}").type.name == "NotFound":
                continue
            with fs.open_input_stream(f"{path}/{c.name}") as f:
                known = np.frombuffer(f.read(), _U)
            first, count, tag, many = segments(c.data, c.starts, c.stops, length, frequent)
            place = np.minimum(np.searchsorted(known, tag), len(known) - 1)
            on = known[place] == tag
            first, count, tag, many = first[on], count[on], tag[on], many[on]
            stop = first + count + length - 1
            text = [c.text[a:b] for a, b in zip(first.tolist(), stop.tolist())]
            seen: dict[bytes, int] = {}
            new = np.fromiter((seen.setdefault(t, k) == k for k, t in enumerate(text)), bool, len(text))
            doc = np.searchsorted(c.stops, first, "right")
            pos = first - c.starts[doc]
            owner, start, end = _merged(doc[~new], pos[~new], (stop - c.starts[doc])[~new])
            at = np.flatnonzero(new)
            blocks = [(k, packed({
                "none": c.none[doc[m]].astype(np.int8), "id": c.ids[doc[m]], "file": c.file[doc[m]], "row": c.row[doc[m]],
                "pos": pos[m], "tag": tag[m].view(np.int64), "many": many[m], "text": [text[i] for i in m.tolist()]}))
                for k, m in ((k, at[x]) for k, x in _by_shard(_shard_of(tag[at], shards)))]
            spans = [(k, packed({"file": c.file[owner[x]], "row": c.row[owner[x]], "start": start[x], "stop": end[x]}))
                     for k, x in _by_shard(owner % shards)]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([k for k, _ in blocks + spans], pa.int64()),
                "block": pa.array([b for _, b in blocks] + [None] * len(spans), pa.binary()),
                "spans": pa.array([None] * len(blocks) + [s for _, s in spans], pa.binary())})

    def sort(group: pa.Table) -> pa.Table:
        out = [unpacked(s) for s in [[x for x in group.column("spans").to_pylist() if x is not None]] if s]
        blocks = [x for x in group.column("block").to_pylist() if x is not None]
        if blocks:
            out.append(_shard_spans(unpacked(blocks), length, bucket))
        return pa.concat_tables(out)

    sent = rows.mapInArrow(send, "shard long, block binary, spans binary")
    return sent.repartition(shards, "shard").groupBy("shard").applyInArrow(sort, _SPANS)


def _shard_spans(block: pa.Table, length: int, bucket: int) -> pa.Table:
    """The spans of a shard's segments (none, id, file, row, pos, tag, many, text)."""
    none, ids, file, row, pos, tag = (block.column(n).to_numpy() for n in ("none", "id", "file", "row", "pos", "tag"))
    order = np.lexsort((pos, row, file, ids, none))
    file, row, pos, tag = file[order], row[order], pos[order], tag[order]
    text = block.column("text").take(pa.array(order)).to_pylist()
    sizes = np.fromiter(map(len, text), np.int64, len(text))
    seen: dict[bytes, int] = {}
    new = np.fromiter((seen.setdefault(t, k) == k for k, t in enumerate(text)), bool, len(text))
    starts, stops, who = [pos[~new]], [(pos + sizes)[~new]], [np.flatnonzero(~new)]
    # windows can repeat in another segment of the same anchor, or in one that holds its anchor more than once
    many = block.column("many").to_numpy()[order]
    _, inverse, counts = np.unique(tag[new], return_inverse=True, return_counts=True)
    at = np.flatnonzero(new)[(counts[inverse.ravel()] > 1) | many[new]]
    if len(at):
        held = np.frombuffer(b"".join([text[k] for k in at.tolist()]) + bytes(2 * COVER + length), np.uint8)
        first = np.cumsum(sizes[at]) - sizes[at]
        count = sizes[at] - length + 1
        again = repeated_windows(held, first, count, length, bucket)
        owner = np.repeat(at, count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        starts.append(pos[owner[again]] + offset[again])
        stops.append(starts[-1] + length)
        who.append(owner[again])
    owner, start, stop = (np.concatenate(x) for x in (who, starts, stops))
    doc = np.cumsum(np.r_[False, (row[1:] != row[:-1]) | (file[1:] != file[:-1])]) if len(row) else row
    of = np.zeros(int(doc[-1]) + 1, np.int64)
    of[doc[::-1]] = np.arange(len(doc))[::-1]
    owner, start, stop = _merged(doc[owner], start, stop)
    return pa.table({"file": file[of[owner]], "row": row[of[owner]], "start": start, "stop": stop})


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                   length: int = LENGTH, numbers: tuple[str, str] | None = None, kept: str | None = None,
                   chunk: int = CHUNK, shard_bytes: int = SHARD_BYTES, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with all columns but ``numbers`` and n_bytes, n_removed, n_spans
    (maximal removed runs) and kept_sha256 of each text; an underscore follows
    names that ``docs`` has.  ``kept``: name of one more column, the remaining
    bytes.

    ``numbers``: columns that number the rows (:func:`common.file_rows`); without them
    ``docs`` is written once, to have such numbers.  Earlier is the smaller id
    (nulls last), of one id the smaller number, in a row the earlier place; so
    of repeated rows one keeps its bytes.  Matches never cross texts.  Null and
    empty texts have no byte; texts shorter than ``length`` stay.
    """
    wanted = [c for c in docs.columns if c not in (numbers or ())]
    if numbers is None:
        docs, numbers = numbered(spark, docs)
    file, row = numbers
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(file).alias("file"), F.col(row).alias("row"),
                       F.col(text).alias("text"))
    found = materialize(spark, repeated_spans(spark, rows, length, chunk, shard_bytes, bucket), "suffixes-spans")
    spans = fresh(docs, "spans")
    by_row = found.groupBy(F.col("file").alias(file), F.col("row").alias(row)).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(spans))
    joined = docs.join(by_row, [file, row], "left").select(*wanted, spans)
    names, typed = [], docs.select(*wanted)
    for name, kind in [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")]:
        names.append(fresh(typed, name))
        typed = typed.withColumn(names[-1], F.lit(None).cast(kind))
    if kept:
        typed = typed.withColumn(kept, F.lit(None).cast("binary"))
    at = wanted.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for value, gone in zip(binaries(b.column(at)), b.column(b.num_columns - 1).to_pylist()):
                value = value or b""
                left, done, runs, removed = [], 0, 0, 0
                for s in gone or ():
                    if s["start"] > done or not runs:
                        left.append(value[done:s["start"]])
                        runs += 1
                    removed += s["stop"] - max(s["start"], done) if s["stop"] > done else 0
                    done = max(done, s["stop"])
                left.append(value[done:])
                rest = b"".join(left)
                out.append((len(value), removed, runs, hashlib.sha256(rest).hexdigest(), rest))
            new = [pa.array([o[k] for o in out], pa.string() if k == 3 else pa.int64()) for k in range(4)]
            if kept:
                new.append(pa.array([o[4] for o in out], pa.binary()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], [*b.schema.names[:-1], *names, *([kept] if kept else [])])

    return joined.mapInArrow(cut, typed.schema)
