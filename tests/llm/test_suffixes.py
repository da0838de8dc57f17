"""Repeated byte strings against a dictionary of windows."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import suffixes
from stratum.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.01"


def slow(rows, length=100):
    """(doc_id, text) in the order of the corpus -> (n_bytes, n_removed, n_spans, sha256, kept)."""
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_cover():
    shift = suffixes.shifts()
    for v in (7, 32, 64):
        d = suffixes.difference_cover(v)
        assert {(a - b) % v for a in d for b in d} == set(range(v)) and len(d) <= 2 * v ** 0.5
    assert all(suffixes._COVERED[(i + shift[i, j]) % 32] and suffixes._COVERED[(j + shift[i, j]) % 32]
               for i in range(32) for j in range(32))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 300), st.integers(32, 300), st.binary(max_size=20)), min_size=1, max_size=10),
       st.sampled_from([b"a", b"ab", b"abcdefgh"]), st.sampled_from([32, 47, 100]), st.sampled_from([5, 60, 10**6]))
def test_repeated_windows(parts, letters, length, bucket):
    rnd = random.Random(5)
    base = [bytes(rnd.choice(letters) for _ in range(500)) for _ in range(4)]
    segs = [x for x in (base[k][a:a + n] + tail for k, a, n, tail in parts) if len(x) >= length]
    if not segs:
        return
    sizes = np.array([len(x) for x in segs])
    data = np.frombuffer(b"".join(segs) + bytes(64 + length), np.uint8)
    got = suffixes.repeated_windows(data, np.cumsum(sizes) - sizes, sizes - length + 1, length, bucket)
    seen, want = set(), []
    for x in segs:
        for i in range(len(x) - length + 1):
            want.append(x[i:i + length] in seen)
            seen.add(x[i:i + length])
    assert got.tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 900), min_size=1, max_size=8), st.booleans())
def test_segments_hold_each_window_once(sizes, frequent):
    rnd = random.Random(6)
    text = bytes(rnd.choice(b"abc") for _ in range(sum(sizes) // 2))
    text += (text[:rnd.randrange(1, 60)] * len(text) or b"z" * 900)[:sum(sizes) - len(text)]
    text = text.ljust(sum(sizes), b"y")
    stops = np.cumsum(sizes)
    data = np.frombuffer(text, np.uint8)
    often = np.unique(suffixes.gram_values(data, np.empty(0, np.uint64))[::7]) if frequent and len(data) > 16 else np.empty(0, np.uint64)
    first, count, tag, many = suffixes.segments(data, stops - sizes, stops, frequent=often)
    got = [i for f, c in zip(first.tolist(), count.tolist()) for i in range(f, f + c)]
    assert got == [i for n, e in zip(sizes, stops.tolist()) for i in range(e - n, e - 99)]
    for f, c, m in zip(first.tolist(), count.tolist(), many.tolist()):
        assert m or len({text[i:i + 100] for i in range(f, f + c)}) == c
    by_text = {}  # equal windows have equal anchors
    for f, c, t in zip(first.tolist(), count.tolist(), tag.tolist()):
        for i in range(f, f + c):
            assert by_text.setdefault(text[i:i + 100], t) == t


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    df = REGISTRY["op13_blockwise_suffix_dedup"](spark, SF)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted(tuple(r) for r in df.collect())
    want = [r[:5] for r in slow(docs)]
    assert got == want and sum(r[2] > 0 for r in want) > 50


def test_oracle():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    docs = con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()
    got = sorted(con.execute(ORACLE["op13_blockwise_suffix_dedup"]).fetchall())
    assert got == [r[:5] for r in slow(docs)]


def test_copies_frequent_lines_and_small_blocks(spark):
    """A line and a passage in a third of all documents, near copies, small
    chunks, shards and buckets."""
    rnd = random.Random(7)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(n))

    line, passage, near = prose(10), prose(60), prose(80)
    rows = []
    for i in range(240):
        own = [prose(rnd.randrange(10, 60)), prose(rnd.randrange(10, 60))]
        if i % 3 == 0:
            own.insert(1, line)
        if i % 4 == 1:
            own.insert(1, passage)
        if i % 5 == 2:
            w = near.split()
            w[rnd.randrange(80)] = "other"
            own = [" ".join(w)]
        rows.append((i * 7 % 240, "\n".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = sorted(tuple(r)[:1] + tuple(r)[2:] for r in suffixes.remove_repeats(
        spark, df, chunk=2_000, shard_bytes=2_000, bucket=300, kept="kept").collect())
    assert got == slow(sorted(rows))
    numbers = df.selectExpr("doc_id AS id", "0L AS file", "doc_id AS row", "text")
    assert len(suffixes._frequent(spark, numbers, 100, 4, 10_000)) > 3


def test_edges(spark):
    rnd = random.Random(8)
    text = "".join(rnd.choice("abcdef \n") for _ in range(400))
    rows = [(1, None), (2, ""), (3, text[:99]), (4, text[:99]), (5, text), (5, text), (6, "x" * 120_000), (7, "xy" * 90),
            (8, "é" * 50), (9, "aé" + "é" * 49), (10, text[150:250]), (11, text[150:250] * 2), (None, text), (12, text[300:] + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_bytes", "2 AS FILE", "3 AS row", "4 AS spans")
    out = suffixes.remove_repeats(spark, df, kept="kept")
    assert out.columns[:6] == df.columns and out.columns[6:] == ["n_bytes_", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = sorted((r[0] is None, r[0] or 0, r[6:]) for r in map(tuple, out.collect()))
    want = sorted((i is None, i or 0, tuple(r)) for i, *r in slow(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))))
    assert got == want
    removed = {}
    for _, i, r in got:
        removed.setdefault(i, []).append(r[1])
    assert removed[5] == [0, 400] and removed[6] == [119_999] and removed[4] == [0] and removed[8] == [0] and removed[9] == [100]
    assert suffixes.remove_repeats(spark, df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_spans(spark, df.selectExpr("doc_id AS id", "1L AS file", "1L AS row", "text"), length=20)
