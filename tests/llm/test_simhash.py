"""SimHash classes against all pairs of fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from stratum.llm import simhash
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text, n=3):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_classes(rows):
    """(doc_id, fp) -> root by comparing all pairs."""
    ids = list(rows)
    root = {d: d for d, _ in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, f) in enumerate(ids):
        for b, g in ids[:i]:
            if (f ^ g).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in root}


def test_query_matches_all_pairs(spark):
    got = {r.doc_id: r for r in REGISTRY["op8_simhash_near_dedup"](spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    fps = [(d, slow_fingerprint(t)) for d, t in docs]
    assert {d: int(got[d].fingerprint, 16) for d, _ in fps} == dict(fps)
    assert {d: r.component_id for d, r in got.items()} == slow_classes(fps)
    assert all(len(r.fingerprint) == 16 for r in got.values())


def classes_of(spark, fps, **kw):
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    groups = {}
    for r in simhash.fingerprint_classes(spark, df, **kw).collect():
        groups.setdefault(r.root, set()).add(int(np.int64(r.fp).view(np.uint64)))
    return sorted(sorted(g) for g in groups.values())


def planted(seed, n, flips):
    rnd = random.Random(seed)
    fps = set()
    for _ in range(n):
        base = rnd.getrandbits(64)
        fps.add(base)
        for _ in range(flips):
            x = base
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
            fps.add(x)
    return sorted(fps)


@pytest.mark.parametrize("limit", [simhash.RUN_LIMIT, 3])  # 3: nearly all runs take the path for wide ones
def test_classes_match_all_pairs(spark, limit):
    fps = planted(limit, 12, 25) + [0, 1, 3, 7, 15, (1 << 64) - 1]
    want = slow_classes([(f, f) for f in fps])
    groups = {}
    for f, r in want.items():
        groups.setdefault(r, []).append(f)
    assert classes_of(spark, fps, run_limit=limit) == sorted(sorted(g) for g in groups.values())


def test_long_runs_are_probed(spark):
    rnd = random.Random(5)  # one high segment, dense low segments: runs beyond LAGS
    fps = sorted({rnd.getrandbits(9) | (0xABCD << 32) for _ in range(400)} |
                 {0x77 | (rnd.getrandbits(8) << 32) for _ in range(300)})
    want = {}
    for f, r in slow_classes([(f, f) for f in fps]).items():
        want.setdefault(r, []).append(f)
    assert classes_of(spark, fps) == sorted(sorted(g) for g in want.values())


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, "x"),
            (8, "X"), (9, "long " * 50000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS root", "3 AS key")
    out = simhash.near_duplicates(spark, df)
    got = sorted((r.doc_id or -1, r.component_id) for r in out.collect())
    assert got == [(-1, 5), (1, 1), (2, 1), (3, 1), (5, 5), (5, 5), (7, 7), (8, 7), (9, 9)]
    kept = simhash.keep_one(spark, df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 7, 9]
    assert simhash.near_duplicates(spark, df.limit(0)).count() == 0
