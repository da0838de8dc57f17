"""Removal of passages that repeat, by sliding runs of sentences.

From every sentence on, and up to every sentence, the shortest run of at least
``RUN`` consecutive sentences with at least ``LEAST_WORDS`` words is hashed, so
a passage is covered to its last sentence; hashes are joined over
the whole corpus, and sentences covered by a run that has been seen before
(smaller id, or earlier in the text) are removed.  Passages are found wherever
they stand, as long as they hold such a run of whole sentences; repeated single
lines and short phrases stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh, numbered, packed, slices, unpacked

#: Sentences of a run, and words that it must have at least (short sentences
#: such as headings meet by chance).
RUN = 2
LEAST_WORDS = 20
#: Longer sentences are cut after words whose hash is divisible by ``CUT``: at
#: the same words in every copy, whatever stands before.
LONG = 12
CUT = 5
#: Runs that a task sorts at a time; bytes of text for each shard of hashes.
CHUNK = 400_000
SHARD_BYTES = 32_000_000

_BREAK = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])(?![。！？」』”’）])\s*|\s*\n\s*")
_WORD = re.compile(r"\S+\s*")
#: Scripts without spaces between words (Thai to Tibetan, Burmese, Khmer, kana,
#: Chinese characters): each character counts as a word.
_SOLID = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ANY_SOLID = re.compile(f"[{_SOLID}]")
_CHARACTER = re.compile(rf"[{_SOLID}]\s*|[^\s{_SOLID}]+\s*")
_U = np.uint64
_MIX = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93))


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences; they lie end to end, each with the white
    space after it, and hold all of the text."""
    solid = not text.isascii() and _ANY_SOLID.search(text)
    word, least = (_CHARACTER, LONG) if solid else (_WORD, 2 * LONG)
    ends = [m.end() for m in _BREAK.finditer(text) if 0 < m.end() < len(text)]
    out = []
    for a, b in zip([0, *ends], [*ends, len(text)]):
        if b - a > least and len(words := word.findall(text, a, b)) > LONG:
            at = a + (b - a - sum(map(len, words)))  # white space before the first word
            first = a
            for w in words:
                at += len(w)
                if at < b and xxhash.xxh64_intdigest(w.rstrip().lower()) % CUT == 0:
                    out.append((first, at))
                    first = at
            out.append((first, b))
        elif b > a:
            out.append((a, b))
    return out


def runs(text: str | None, run: int = RUN, least_words: int = LEAST_WORDS
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of sentences, the hashes (without regard to case and kinds
    of white space; 64 bits and 32 more), and the numbers of the first and after
    the last sentence."""
    marks = sentences(text or "")
    split = [text[a:b].lower().split() for a, b in marks]
    sizes = map(len, split)
    if text and not text.isascii() and _ANY_SOLID.search(text):
        sizes = (len(_CHARACTER.findall(text, a, b)) for a, b in marks)
    words = np.cumsum([0, *sizes])
    k = np.arange(len(marks))
    end = np.maximum(np.searchsorted(words, words[:-1] + least_words), k + run)
    first = np.minimum(np.searchsorted(words, words[1:] - least_words, "right") - 1, k + 1 - run)
    pairs = np.r_[k[end <= len(marks)] * (len(marks) + 1) + end[end <= len(marks)],
                  first[first >= 0] * (len(marks) + 1) + k[first >= 0] + 1]
    first, end = np.divmod(np.unique(pairs), len(marks) + 1)
    digests = b"".join([xxhash.xxh3_128_digest(" ".join(s)) for s in split])
    hashes = np.frombuffer(digests, _U).reshape(-1, 2)
    total = np.zeros((len(first), 2), _U)
    for k in range(int((end - first).max(initial=0))):
        on = first + k < end
        mixed = (total ^ (total >> _U(29))) * _MIX[k % 4] + hashes[np.minimum(first + k, len(marks) - 1)]
        total = np.where(on[:, None], mixed, total)
    total = (total ^ (total >> _U(32))) * _MIX[0]
    return total[:, 0], (total[:, 1] >> _U(32)).astype(np.uint32), first.astype(np.int32), end.astype(np.int32)


def without(text: str, gone: set[int]) -> str:
    """The text without these sentences."""
    return "".join(text[a:b] for k, (a, b) in enumerate(sentences(text)) if k not in gone)


_FIELDS = (("h", np.uint64), ("more", np.uint32), ("none", np.uint8), ("doc_id", np.int64), ("file", np.int64), ("row", np.int64),
           ("pos", np.int32), ("stop", np.int32))


def _first_and_again(runs_: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The runs in the order of their hashes and, of equal ones, of the corpus;
    and which of them are not the first of their hash."""
    order = np.lexsort([runs_[n] for n in ("pos", "row", "file", "doc_id", "none", "more", "h")])
    in_order = {n: v[order] for n, v in runs_.items()}
    h, more = in_order["h"], in_order["more"]
    return in_order, np.r_[False, (h[1:] == h[:-1]) & (more[1:] == more[:-1])]


def _block(runs_: dict[str, np.ndarray]) -> bytes:
    """Runs in the order of their hashes, as bytes: hash differences and the
    other numbers, byte by byte, compressed."""
    columns = [np.diff(runs_["h"], prepend=_U(0)), *(runs_[n] for n, _ in _FIELDS[1:])]
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return len(columns[0]).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unblock(data: bytes) -> dict[str, np.ndarray]:
    n, at, out = int.from_bytes(data[:4], "little"), 0, {}
    raw = np.frombuffer(pa.decompress(data[4:], n * sum(np.dtype(t).itemsize for _, t in _FIELDS), codec="zstd",
                                      asbytes=True), np.uint8)
    for name, kind in _FIELDS:
        size = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).ravel()
        at += n * size
    out["h"] = np.cumsum(out["h"], dtype=np.uint64)
    return out


_PLACE = ("file", "row", "pos", "stop")
_AGAIN = "file long, row long, pos int, stop int"


def repeated(spark: SparkSession, rows: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """(file, row, pos, stop): the runs of ``rows`` (doc_id, file, row, text)
    that are not the first of their hash.  (file, row) must number the rows.

    A task sorts its runs, some hundred thousand at a time.  Of equal ones all
    but the first are known to repeat then and there; only the first is compared,
    in compressed blocks by ranges of hashes, so a passage in a third of all
    documents costs a range one entry for each of these chunks.
    """
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def split(found: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        runs_, again = _first_and_again({n: np.concatenate([f[n] for f in found]) for n, _ in _FIELDS})
        first = {n: v[~again] for n, v in runs_.items()}
        shard = ((first["h"] >> _U(32)) * _U(shards) >> _U(32)).astype(np.int32)
        cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
        blocks = [_block({n: v[a:b] for n, v in first.items()}) for a, b in zip(cuts[:-1], cuts[1:])]
        # what repeats here goes along with any shard, to be one of its results
        known = np.array_split(np.flatnonzero(again), len(blocks)) if blocks else []
        places = [packed({n: runs_[n][at] for n in _PLACE}) for at in known]
        return pa.RecordBatch.from_pydict({"shard": pa.array(shard[cuts[:-1]]), "block": pa.array(blocks, pa.binary()),
                                           "places": pa.array(places, pa.binary())})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in slices(batches, 3):
            for doc_id, file, row, text in zip(*(c.to_pylist() for c in b.columns)):
                h, more, pos, stop = runs(text, run, least_words)
                if not len(h):
                    continue
                held.append({"h": h, "more": more, "none": np.full(len(h), doc_id is None, np.uint8),
                             "doc_id": np.full(len(h), doc_id or 0, np.int64), "file": np.full(len(h), file, np.int64),
                             "row": np.full(len(h), row, np.int64), "pos": pos, "stop": stop})
                n += len(h)
                if n >= CHUNK:
                    yield split(held)
                    held, n = [], 0
        if held:
            yield split(held)

    def merge(group: pa.Table) -> pa.Table:
        parts = [_unblock(b) for b in group.column("block").to_pylist()]
        runs_, again = _first_and_again({n: np.concatenate([p[n] for p in parts]) for n, _ in _FIELDS})
        over = pa.table({n: runs_[n][again] for n in _PLACE})
        return pa.concat_tables([unpacked(group.column("places").to_pylist()), over])

    made = rows.select(F.col("doc_id").cast("long"), "file", "row", "text").mapInArrow(
        find, "shard int, block binary, places binary")
    return made.repartition(shards, "shard").groupBy("shard").applyInArrow(merge, _AGAIN)


def remove_repeats(spark: SparkSession, docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS,
                   text: str = "text", count: str | None = None,
                   numbers: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with all columns but ``numbers``, ``text`` without sentences of
    repeated runs.

    ``numbers``: columns that number the rows (:func:`common.file_rows`);
    without them ``docs`` is written once, to have such numbers.
    The first of equal runs is that of the smallest ``doc_id`` (nulls last),
    of the first row with that id, and the earliest in its text; it stays.
    ``count``: name of an added column, the number of removed sentences.
    Null and empty texts, and texts without a run, stay as they are; of
    repeated rows all but one lose their sentences, so a text can become
    empty.
    """
    wanted = [c for c in docs.columns if c not in (numbers or ())]
    if numbers is None:
        docs, numbers = numbered(spark, docs)
    file, row = numbers
    spots, n = fresh(docs, "spots"), count or fresh(docs, "removed")
    rows = docs.select("doc_id", F.col(file).alias("file"), F.col(row).alias("row"), F.col(text).alias("text"))
    found = repeated(spark, rows, run, least_words)
    again = found.groupBy(F.col("file").alias(file), F.col("row").alias(row)).agg(
        F.collect_list(F.struct("pos", "stop")).alias(spots))
    joined = docs.join(again, [file, row], "left").select(*wanted, spots)
    at = joined.columns.index(text)
    schema = docs.select(*wanted, F.lit(0).cast("long").alias(n)).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            gone = [{k for r in x or () for k in range(r["pos"], r["stop"])} for x in b.column(b.num_columns - 1).to_pylist()]
            new = [without(t, g) if g else t for t, g in zip(b.column(at).to_pylist(), gone)]
            columns = list(b.columns[:-1])
            columns[at] = pa.array(new, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, gone)), pa.int64())], [*b.schema.names[:-1], n])

    out = joined.mapInArrow(cut, schema)
    return out if count else out.drop(n)
