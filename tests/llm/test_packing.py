"""Packing: exact ids, gapless sequences, little padding."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratum.llm import packing
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(str(public_tokenizers.path(packing.TOKENIZER)))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(str(public_tokenizers.path(packing.TOKENIZER)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r  \x1cab'sé1.,|<>😀x", max_size=40), max_size=4))
def test_chunked_ids_are_the_tokenizers(tokenizer, encoder, texts):
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.ids(texts)] == want


def test_memory_is_bounded(tokenizer, encoder, monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 5)
    own = packing.Encoder(str(public_tokenizers.path(packing.TOKENIZER)))
    for k in range(6):
        t = [f"one two three w{k}x w{k}y four", "x" * 500, "<|endoftext|> a  b"]
        assert [x.tolist() for x in own.ids(t)] == [tokenizer.encode(x, add_special_tokens=False).ids for x in t]
    assert len(own._of) <= 5 + 9


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
@settings(max_examples=100, deadline=None)
def test_patterns_hold_every_piece(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    seen = collections.Counter()
    for p, n in patterns:
        assert sum(p) <= 64 and n > 0 and list(p) == sorted(p, reverse=True)
        for size in p:
            seen[size] += n
    assert seen == histogram


def check(rows, docs, length, tokenizer, end=packing.END_ID):
    """Pieces against the documents (repeated rows allowed)."""
    by_seq = collections.defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    want = collections.Counter()
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        for i in range(0, len(ids), length):
            part = ids[i:i + length]
            want[(d, i, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    return sum(r.length for r in rows) / (length * len(by_seq)) if by_seq else 1.0


def test_query(spark, tokenizer):
    rows = REGISTRY["op4_histogram_packing"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check(rows, docs, packing.LENGTH, tokenizer) > 0.97


def test_edges(spark, tokenizer):
    docs = [(1, None), (2, ""), (2, ""), (None, "null id"), (5, "word " * 3000), (6, "a<|endoftext|>b"), (7, "  two  spaces ")]
    docs += [(10 + i, "same text in every row") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS task", "3 AS nth")
    rows = packing.pack(spark, df.repartition(4), length=64).collect()
    assert check(rows, docs, 64, tokenizer) > 0.9
    assert packing.pack(spark, df.limit(0)).count() == 0


def test_a_word_is_looked_up_once_for_many_texts(tokenizer, encoder, monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    monkeypatch.setattr(encoder, "_of", Counted(encoder._of))
    texts = ["same words in\nevery text", "x" * 300 + " words", "same"] * 200
    assert [x.tolist() for x in encoder.ids(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder._of.asked <= 10
