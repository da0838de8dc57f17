"""Periodic runs against every lag of every text."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import periodic
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def least_period(w):
    fail = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k]
        k += w[i] == w[k]
        fail[i + 1] = k
    return len(w) - fail[len(w)]


def slow_runs(words):
    """All maximal stretches of every period, those of the smallest only."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and least_period(words[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text, plant=True):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    gone = {i for s, ln, q in found for i in range(s + q, s + ln)}
    top = min(found, key=lambda r: (-(r[1] / r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120)
       | st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 9)), max_size=6)
       .map(lambda parts: [x for p, k in parts for x in p * k]))
def test_runs(words):
    assert periodic.runs(np.array(words, np.int64)) == slow_runs(words)


def test_classes_hold_each_lag_once_and_pairs_fit():
    classes = periodic.lag_classes(10_000)
    assert [q for a, b, _ in classes for q in (a, b)] == sorted(q for a, b, _ in classes for q in (a, b))
    assert all(classes[i + 1][0] == classes[i][1] + 1 for i in range(len(classes) - 1)) and classes[-1][1] == 10_000
    for a, b, k in classes:
        assert 2 * b <= k and a + k <= max(6, 4 * a)  # the periods fit a seed, and the seed each run's diagonal


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in REGISTRY["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        if len(text or "") < 12_000 or zlib.crc32(str(doc_id).encode()) % 10 == 0 and len(text) < 20_000:
            assert got[doc_id] == slow_row(doc_id, text)
    assert sum(r[0] > 0 for r in got.values()) > 60


def test_edges(spark):
    rnd = random.Random(4)
    block = " ".join(rnd.choice("abcdefg") for _ in range(3_000))
    texts = [None, "", " \t\r\n", "one", "x " * 5, "x " * 6, "a b " * 3 + "a", "a b " * 4, "A b a b a b a b",
             "x " * 50_000, (block + " ") * 5, "  " * 7, "q\x0bq\x0cq\x85q q\tq q q", "x " * 6 + "y " * 6, "x" * 300_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "x " * 6), (None, "y " * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS N_RUNS", "8 AS start", "9 AS words")
    out = periodic.periodic_runs(df)
    assert out.columns[:5] == df.columns and out.columns[5:7] == ["n_runs_", "start_"] and len(set(out.columns)) == len(out.columns)
    got = sorted(((r[0] is None, r[0] or 0, r[1] or ""), tuple(r)[5:]) for r in out.collect())
    want = sorted(((i is None, i or 0, t or ""), slow_row(i, t, plant=False)) for i, t in rows if len(t or "") < 20_000)
    assert [g for g in got if g[0] in {w[0] for w in want}] == want
    by_id = {k[1]: v for k, v in got if not k[0]}
    assert by_id[9][:5] == (1, 0, 50_000, 1, 50_000_000)
    assert (0, 15_000, 3_000) == by_id[10][1:4] or by_id[10][0] > 1
    assert (10, 0, 15_000, 3_000) in [tuple(r) for r in periodic.listed_runs(df).collect()]
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    planted = periodic.periodic_runs(df, plant=True).where("doc_id IS NULL").first()
    assert planted["period"] == 1 and planted["length"] == 8
