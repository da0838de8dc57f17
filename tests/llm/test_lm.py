"""The trie against dictionaries of n-grams with the same smoothing."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import lm
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


class Slow:
    def __init__(self, texts, order=3, least=1):
        grams = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = [None, *tokens(t)]
            grams[1].update(w[1:])
            for n in range(2, order + 1):
                grams[n].update(tuple(w[i - n + 1:i + 1]) for i in range(n - 1, len(w)))
        self.n = sum(grams[1].values())
        self.uni, self.order = grams[1], order
        self.grams, self.discount = {}, {}
        lower = {(w,): c for w, c in grams[1].items()}
        for n in range(2, order + 1):
            # an n-gram counts only where its parts were kept
            here = {g: c for g, c in grams[n].items() if n == 2 or (g[:-1] in lower and g[1:] in lower)}
            once, twice = (sum(c == k for c in here.values()) for k in (1, 2))
            self.discount[n] = once / (once + 2 * twice) if once and twice else 0.5
            lower = self.grams[n] = {g: c for g, c in here.items() if c >= least}
        self.inside = Counter()
        for n in range(2, order + 1):
            for g, c in self.grams[n].items():
                self.inside[g[:-1]] += c - self.discount[n]

    def base(self, w):
        return (self.uni[w] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))

    def p(self, context, w):
        out = self.base(w)
        for n in range(2, self.order + 1):
            h = tuple(context[-(n - 1):]) if len(context) >= n - 1 else None
            if h is None:
                break
            count = self.uni[h[0]] if n == 2 else self.grams[n - 1].get(h, 0)
            if not count:
                continue
            c = self.grams[n].get((*h, w), 0)
            out = (c - self.discount[n]) / count * (c > 0) + max(1 - self.inside[h] / count, 1e-12) * out
        return out

    def score(self, text):
        w = [None, *tokens(text)]
        return sum(math.log10(self.p(w[:i], w[i])) for i in range(1, len(w)))


def check(got, texts, held_out, order=3):
    slow = Slow([t for t, h in zip(texts, held_out) if not h], order)
    for r, t, h in zip(got, texts, held_out):
        w = tokens(t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (h, len(w), slow.n)
        assert r.n_known == sum(slow.uni[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10(slow.base(x)) for x in w), abs=1e-9)
        assert r.score == pytest.approx(slow.score(t), abs=len(w) / 2900 + 1e-9)


def test_query_matches_dictionaries(spark):
    got = {r.doc_id: r for r in REGISTRY["op3_ngram_trie_lm"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs]
    check([got[d.doc_id] for d in docs], [d.text for d in docs], held)
    better = [r.score - r.base_score for r in got.values() if not r.held_out]
    assert np.mean(better) > 0


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_and_long_texts(spark, monkeypatch, order):
    rnd = np.random.default_rng(order)
    words = np.array(["a", "B", "c", "dé", "e", "f", "g h", "i"])
    texts = [" ".join(rnd.choice(words, rnd.integers(0, 60), p=[.4, .2, .1, .1, .1, .05, .03, .02])) for _ in range(150)]
    texts += ["a b c " * 5000, None, "", "\t \n", "zz yy a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS shard")
    got = sorted(lm.train_and_score(spark, df, F.col("doc_id") % 5 == 0, order=order, shard=500).collect())
    check(got, texts, [i % 5 == 0 for i in range(len(texts))], order)


def test_probabilities_sum_to_one():
    slow = Slow(["a b a b c", "a b c c", "b a"])
    for context in ([None], ["a"], ["a", "b"], ["b", "c"]):
        total = sum(slow.p(context, w) for w in slow.uni) + slow.p(context, "unknown")
        assert total == pytest.approx(1)


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = lm.train_and_score(spark, df, F.col("doc_id").isNull()).collect()
    assert [r.n_tokens for r in rows] == [3, 3, 3] and {r.train_tokens for r in rows} == {6}
    none = lm.train_and_score(spark, df, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in none} == {(0, 0, 0.0, 0.0)}
    assert lm.train_and_score(spark, df.limit(0), F.lit(False)).count() == 0
