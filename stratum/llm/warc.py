"""WARC archives with a two-level capture index.

Records are written as gzip members to archive files of the shared folder.
Their captures are sorted by reversed-host key (``com,example)/path``) and cut
into compressed blocks; a sparse directory has one entry for each block, its
first key and its place.  A capture is found by binary search in the directory,
one range read of a block, and binary search in the block; then its record is
one range read of the archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit
from uuid import UUID

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import filesystem, materialize, read_range, slices, unique_file, writing
from stratum.session import scratch_path

LEAST_REVISIT = 1000
BLOCK_LINES = 512
#: Neighbouring records are fetched by one read up to this size.
FETCH_BYTES = 8 << 20
#: Archive bytes that a task reads back.
TASK_BYTES = 64 << 20

# WARC 1.1 names.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages have no capture date


def surt(url: str | None) -> str:
    """The reversed-host key of a URL: lower-case host labels from the right,
    a port other than the scheme's, then path and query as they are, without
    the fragment.  What is no URL with a host is its own key, in lower case."""
    text = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return text.lower()
    if ":" not in host:  # not an IPv6 address
        host = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        host += f":{port}"
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def record_id(page_id: int | None) -> str:
    """A URN that holds the id; an unknown id has the nil UUID."""
    if page_id is None:
        return f"<urn:uuid:{UUID(int=0)}>"
    high, low = (page_id & (1 << 64) - 1) >> 32, page_id & (1 << 32) - 1
    return f"<urn:uuid:{UUID(int=high << 96 | 0x8 << 76 | 0x8 << 60 | low)}>"  # a custom UUID (version 8, variant 1)


def page_of(urn: str) -> int | None:
    n = UUID(urn.strip("<>").rpartition(":")[2]).int
    if not n:
        return None
    bits = (n >> 96) << 32 | n & (1 << 32) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def sha1(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
           revisit: bool = False) -> bytes:
    """One record as a gzip member.  A revisit has the HTTP headers of the
    response it stands for, with the payload's length, and no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    target = quote(url or "", safe="!#$&'()*+,/:;=?@[]~")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: {sha1(payload)}",
            f"WARC-Block-Digest: {sha1(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse(member: bytes) -> Record:
    """A record from its gzip member; raises if a digest or length is wrong."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if lines[0].encode() != VERSION or rest[len(block):] != b"\r\n\r\n" or sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    text, _, payload = block.partition(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in text.decode().split("\r\n")[1:])
    if headers["WARC-Type"] == "response" and sha1(payload) != headers["WARC-Payload-Digest"]:
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return Record(headers, http, payload)


def _originals(pages: DataFrame, least: int) -> DataFrame:
    """``pages`` (page_id, url, payload) and ``original``: the largest id that
    has the same payload of at least ``least`` bytes, where there are several."""
    sized = pages.withColumn("digest", F.sha1("payload"))
    shared = (sized.where(F.octet_length("payload") >= least).groupBy("digest")
              .agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 AND original IS NOT NULL"))
    return sized.join(shared.drop("n"), "digest", "left").drop("digest")


_CAPTURES = "key string, capture string, page_id long, file string, offset long, length long"


def write_archives(spark: SparkSession, pages: DataFrame, base: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); the
    captures, with file, offset and length of each record.

    Archives have names of their own, made up by each task attempt, and only
    captures of attempts that succeeded are kept: an archive of a lost attempt
    is never referred to.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url",
                        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = _originals(rows, least).select("page_id", "url", "payload", "original")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = slices(batches, 2)
        first = next(batches, None)
        if first is None:
            return
        path = unique_file(base, "archive", ".warc.gz")
        done, at = [], 0
        with writing(path) as out:
            for b in itertools.chain([first], batches):
                for page_id, url, payload, original in zip(*(c.to_pylist() for c in b.columns)):
                    revisit = original is not None and page_id != original
                    gz = record(page_id, url, payload, original if revisit else None, revisit)
                    out.write(gz)
                    done.append((surt(url), record_id(page_id), page_id, path, at, len(gz)))
                    at += len(gz)
        for i in range(0, len(done), 10_000):  # places only, once the file is closed
            yield pa.RecordBatch.from_arrays([pa.array(c) if k != 2 else pa.array(c, pa.int64())
                                              for k, c in enumerate(zip(*done[i:i + 10_000]))],
                                             [c.split()[0] for c in _CAPTURES.split(", ")])

    return materialize(spark, rows.mapInArrow(run, _CAPTURES), "warc-captures")


_PARTS = "first string, index string, directory string, captures long"
_PLACES = "full string, file string, offset long, length long"


def write_index(spark: SparkSession, captures: DataFrame, base: str, lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures by (key, capture) over range partitions; each writes a
    file of compressed blocks and a sparse directory with the first key and
    place of each block.  A row for each partition that has captures."""
    ordered = captures.select(F.concat_ws("\t", "key", "capture").alias("full"), "file", "offset", "length")
    ordered = ordered.repartitionByRange(F.col("full")).sortWithinPartitions("full", "file", "offset")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = (f for f in frames if len(f))
        first = next(frames, None)
        if first is None:
            return
        index, directory = unique_file(base, "index", ".gz"), unique_file(base, "directory", ".gz")
        entries, held, at, n = [], [], 0, 0
        with writing(index) as out:
            def close(block):
                nonlocal at
                data = zlib.compress("\n".join("\t".join(map(str, x)) for x in block).encode(), 6)
                out.write(data)
                entries.append(f"{block[0][0]}\t{at}\t{len(data)}")
                at += len(data)

            for f in itertools.chain([first], frames):
                n += len(f)
                held += list(f.itertuples(index=False, name=None))
                while len(held) >= lines:
                    close(held[:lines])
                    held = held[lines:]
            if held:
                close(held)
        with writing(directory) as out:
            out.write(zlib.compress("\n".join(entries).encode(), 6))
        yield pd.DataFrame([(first.iloc[0, 0], index, directory, n)], columns=[c.split()[0] for c in _PARTS.split(", ")])

    return materialize(spark, ordered.mapInPandas(run, _PARTS), "warc-index")


class Index:
    """One partition of the index: its directory in memory, its blocks read by
    range when they are wanted; the last one is kept.  ``reads`` counts them."""

    def __init__(self, index: str, directory: str):
        fs, p = filesystem(directory)
        with fs.open_input_file(p) as f:
            entries = [x.rsplit("\t", 2) for x in zlib.decompress(f.read()).decode().split("\n")]
        self._first = [x[0] for x in entries]
        self._place = [(int(o), int(n)) for _, o, n in entries]
        self._file = index
        self._at, self._rows, self._keys, self.reads = -1, [], [], 0

    def _load(self, at: int) -> None:
        if self._at != at:
            data = zlib.decompress(read_range(self._file, *self._place[at])).decode()
            self._rows = [x.rsplit("\t", 3) for x in data.split("\n")]
            self._keys = [x[0] for x in self._rows]
            self._at, self.reads = at, self.reads + 1

    def find(self, full: str) -> list[tuple[str, int, int]]:
        """(file, offset, length) of the captures with exactly this key."""
        found = []
        at = max(bisect.bisect_left(self._first, full) - 1, 0)
        while at < len(self._first) and self._first[at] <= full:
            self._load(at)
            k = bisect.bisect_left(self._keys, full)
            while k < len(self._keys) and self._keys[k] == full:
                found.append((self._rows[k][1], int(self._rows[k][2]), int(self._rows[k][3])))
                k += 1
            at += 1
        return found


def locate(spark: SparkSession, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Places of the captures ``wanted`` (key, capture): full, file, offset,
    length.  Wanted keys go to their index partition by binary search among
    the partitions' first keys (one for each), and there in key order through
    its directory, so every block is read once."""
    parts = sorted(index.collect(), key=lambda r: r.first)  # one row for each partition
    first = [r.first for r in parts]
    if not parts:
        return spark.createDataFrame([], _PLACES)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(part=[max(bisect.bisect_right(first, k) - 1, 0) for k in f["full"]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_part, part = None, -1
        for f in frames:
            got = []
            for full, p in f.itertuples(index=False):
                if p != part:
                    part, open_part = p, Index(parts[p]["index"], parts[p]["directory"])
                got += [(full, *x) for x in open_part.find(full)]
            yield pd.DataFrame(got, columns=[c.split()[0] for c in _PLACES.split(", ")])

    keys = wanted.select(F.concat_ws("\t", "key", "capture").alias("full")).distinct()
    routed = keys.mapInPandas(route, "full string, part int")
    return routed.repartition(F.col("part")).sortWithinPartitions("part", "full").mapInPandas(run, _PLACES)


_READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
         "target_uri string, payload binary")


def read_records(places: DataFrame, payloads: bool = False) -> DataFrame:
    """The records at ``places`` (file, offset, length), each parsed and its
    digests checked.  Places are sorted by archive and offset, and
    neighbouring ones fetched by one read.  ``payload`` is null unless
    ``payloads``, and always for revisits."""
    total = places.agg(F.sum("length")).first()[0] or 0  # by archive bytes: the rows themselves are tiny
    ordered = (places.select("file", "offset", "length")
               .repartitionByRange(max(1, -(-total // TASK_BYTES)), F.col("file"), F.col("offset"))
               .sortWithinPartitions("file", "offset"))

    def rows(frames):
        run: list[tuple[str, int, int]] = []
        for f in frames:
            for place in f.itertuples(index=False, name=None):
                if run and (place[0] != run[0][0] or place[1] + place[2] - run[0][1] > FETCH_BYTES
                            or place[1] > run[-1][1] + run[-1][2] + (1 << 16)):
                    yield run
                    run = []
                run.append(place)
        if run:
            yield run

    def one(member: bytes):
        r = parse(member)
        kind = r.headers["WARC-Type"]
        digest = base64.b32decode(r.headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        refers = page_of(r.headers["WARC-Refers-To"]) if kind == "revisit" else None
        size = int(r.http["Content-Length"]) if kind == "revisit" else len(r.payload)
        return (page_of(r.headers["WARC-Record-ID"]), size, digest, kind, refers, unquote(r.headers["WARC-Target-URI"]),
                r.payload if payloads and kind == "response" else None)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
                            ("payload", pa.binary())])
        for run in rows(b.to_pandas() for b in frames):
            base = run[0][1]
            data = read_range(run[0][0], base, run[-1][1] + run[-1][2] - base)
            out = [one(data[o - base:o - base + n]) for _, o, n in run]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

    return ordered.mapInArrow(read, _READ)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST_REVISIT, payloads: bool = False) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives, index the captures,
    look every page up in the index and read its record back.

    Of equal payloads of at least ``least`` bytes the record with the largest
    page_id is the response, rows that tie on it included; the others are
    revisits of it.  Null html is an empty payload, a null url the empty
    target; a null page_id stays null and is never referred to (equal
    payloads with null ids only are all responses).  Repeated rows are
    records of their own.  An empty table has no record; other columns play
    no part.
    """
    base = scratch_path(spark, "warc")
    captures = write_archives(spark, pages, base, least)
    index = write_index(spark, captures, base)
    places = materialize(spark, locate(spark, index, captures.select("key", "capture")), "warc-places")
    return read_records(places, payloads)
