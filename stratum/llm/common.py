"""Helpers shared by the operators: folds, shared-folder files, row groups."""

from __future__ import annotations

import contextlib
import mmap
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, mod: int) -> Column:
    """``crc32`` of the id's decimal text modulo ``mod``; a null id counts as
    the empty text (crc32 0, fold 0)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(mod))


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, and what was computed once is not computed again."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def file_rows(scan: DataFrame, file: str, row: str) -> DataFrame:
    """The rows of a Parquet scan with numbers that their files give them."""
    return scan.withColumn(file, F.xxhash64("_metadata.file_path")).withColumn(row, F.col("_metadata.row_index"))


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, tuple[str, str]]:
    """``docs`` written once with two columns that number its rows, and their
    names: the same numbers each time it is read."""
    file, row = fresh(docs, "file"), fresh(docs, "row")
    return materialize(spark, docs.withColumn(file, F.lit(0).cast("long"))
                       .withColumn(row, F.monotonically_increasing_id()), "numbered"), (file, row)


def binaries(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes (no decoding)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: int, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that column ``text`` holds about ``size`` bytes in
    each (a longer text stands alone): a task holds few texts as Python
    objects at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 200
        part = (np.cumsum(n) - n) // size
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for at, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield b.slice(at, end - at)


def packed(columns: dict) -> bytes:
    """Columns of one length as compressed bytes, for one row of a shuffle."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(parts: list[bytes]) -> pa.Table:
    """The rows of several :func:`packed`."""
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in parts]).combine_chunks()


# --- files in the shared folder -------------------------------------------

def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path and the path inside it."""
    if re.match(r"^(file:)?/", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


def unique_file(base: str, stem: str, suffix: str) -> str:
    """A name no other task attempt uses: files of failed or speculative
    attempts are never referred to."""
    return f"{base}/{stem}-{uuid.uuid4().hex}{suffix}"


@contextlib.contextmanager
def writing(path: str):
    fs, p = filesystem(path)
    fs.create_dir(os.path.dirname(p), recursive=True)
    with fs.open_output_stream(p, compression=None) as out:
        yield out


def read_range(path: str, offset: int, length: int) -> bytes:
    fs, p = filesystem(path)
    with fs.open_input_file(p) as f:
        return f.read_at(length, offset)


def mapped(path: str) -> memoryview:
    """The file memory-mapped: in place when the shared folder is a mounted
    one, else by way of a temporary copy that vanishes with the mapping."""
    fs, p = filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(p, "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    with tempfile.TemporaryFile() as tmp, fs.open_input_stream(p) as src:
        while chunk := src.read(1 << 22):
            tmp.write(chunk)
        tmp.flush()
        return memoryview(mmap.mmap(tmp.fileno(), 0, access=mmap.ACCESS_READ))


def save_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays one after another, 8-byte aligned, behind a small header."""
    head, at, parts = [], 0, []
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        head.append(f"{name} {a.dtype.str} {at} {a.size}")
        parts.append(a)
        at += a.nbytes + (-a.nbytes) % 8
    text = ("\n".join(head)).encode()
    text += b" " * ((-len(text) - 8) % 8)
    with writing(path) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for a in parts:
            out.write(a.tobytes() + b"\0" * ((-a.nbytes) % 8))


def load_arrays(path: str) -> dict[str, np.ndarray]:
    """:func:`save_arrays`' arrays as views of the mapped file."""
    view = mapped(path)
    size = int.from_bytes(view[:8], "little")
    out = {}
    for line in bytes(view[8:8 + size]).decode().rstrip().split("\n"):
        name, kind, at, n = line.split()
        out[name] = np.frombuffer(view, dtype=np.dtype(kind), count=int(n), offset=8 + size + int(at))
    return out


# --- links ---------------------------------------------------------------

def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reachable) that connect what the pairs
    (a, b) connect; at most one per node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        lx, ly = label[x], label[y]
        if np.array_equal(lx, ly):
            break
        np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
        while not np.array_equal(label, label[label]):
            label = label[label]
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]
