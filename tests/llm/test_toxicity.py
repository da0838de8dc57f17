"""The CRF against brute force over tag sequences, and held-out accuracy."""

import itertools
import math
import zlib

import numpy as np
import pytest

from stratum.llm import toxicity
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def slow_marginals(emit, start, moves):
    n, total, on = len(emit), 0.0, np.zeros(len(emit))
    for tags in itertools.product((0, 1), repeat=n):
        s = start[tags[0]] + sum(emit[i] for i in range(n) if tags[i])
        s += sum(moves[a][b] for a, b in zip(tags, tags[1:]))
        total += math.exp(s)
        on += math.exp(s) * np.array(tags)
    return on / total


def test_marginals_match_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", 3)  # several blocks a document
    rnd = np.random.default_rng(1)
    lengths = np.array([5, 0, 1, 9, 3, 12, 0])
    emit = rnd.normal(0, 3, lengths.sum())
    start, moves = rnd.normal(0, 1, 2), rnd.normal(0, 1, (2, 2))
    got, expected, first = toxicity.marginals(emit, lengths, start, moves, True)
    parts = [x for x in np.split(emit, np.cumsum(lengths)[:-1]) if len(x)]
    want = [slow_marginals(x, start, moves) for x in parts]
    np.testing.assert_allclose(got, np.concatenate(want), atol=1e-9)
    np.testing.assert_allclose(first, [w[0] for w in want], atol=1e-9)
    assert expected.sum() == pytest.approx(sum(len(x) - 1 for x in parts))
    np.testing.assert_allclose(expected.sum(axis=0)[1], sum(w[1:].sum() for w in want), atol=1e-8)


def test_long_document_is_stable():
    p = toxicity.marginals(np.random.default_rng(0).normal(0, 5, 100_000), np.array([100_000]),
                           np.zeros(2), np.log([[.99, .01], [.5, .5]]))
    assert np.isfinite(p).all() and (p >= 0).all() and (p <= 1).all()


def test_held_out_accuracy_and_contract(spark):
    out = REGISTRY["op2_crf_toxicity"](spark, SF)
    assert dict(out.dtypes) | {"score": "double", "predicted": "int", "held_out": "boolean"} == dict(out.dtypes)
    rows = {r.doc_id: r for r in out.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
        assert all(0 <= o.start < o.end <= len(texts[d]) for o in r.offsets)
    held = [d for d in labels if rows[d].held_out]
    right = [rows[d].predicted == labels[d] for d in held]
    assert sum(right) / len(right) >= 0.95  # 286 documents to learn from
    toxic = [rows[d].predicted for d in held if labels[d]]
    assert sum(toxic) / len(toxic) >= 0.7  # 18 of them, about 30 to learn from


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, f"{t} word{i}", 7) for i, t in enumerate(["you total idiot go", "fine calm day", "such an IDIOT!", "nice words here"] * 8)]
        + [(None, None, 7), (99, "", 7), (99, "", 7), (100, "idiot " * 30000, 7)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(32)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(spark, docs, labels)
    kept = toxicity.keep_clean(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, *range(1, 32, 2), 99, 99]
    out = toxicity.with_scores(docs.drop("score"), model).collect()
    spans = {r.doc_id: r.offsets for r in out}
    assert [(s.start, s.end) for s in spans[2]] == [(8, 13)] and spans[1] == []
    empty = toxicity.train(spark, docs, labels.limit(0))  # no label: every score is the prior
    assert {r.score for r in toxicity.with_scores(docs.drop("score"), empty).collect()} == {0.5}
    assert toxicity.with_scores(docs.drop("score").limit(0), model).count() == 0


def test_rare_toxic_words_and_copies():
    """A word in 12 of 1,500 toxic texts is learnt, with most others copies of one text too."""
    rnd = np.random.default_rng(3)
    clean = [" ".join(f"c{k}" for k in rnd.integers(0, 300, 12)) for _ in range(1500)]
    toxic = [" ".join(f"c{k}" for k in rnd.integers(0, 300, 12)) + f" slur{chr(97 + i % 19) * 4}" for i in range(228)]
    for copies in (0, 1272):
        texts = clean + toxic + ["vile text of one bot"] * copies
        model = toxicity.fit(texts, [0] * 1500 + [1] * (228 + copies))
        assert all(model.emission(f"slur{chr(97 + i) * 4}".encode()) > 1 for i in range(19))
    # 12 of 1,500 toxic texts hold each of 125 words, no clean one does
    docs = [np.array([i % 125, 200 + i], np.int32) for i in range(1500)] + [np.array([1700 + i], np.int32) for i in range(1500)]
    found = toxicity._toxic_features(docs, np.array([1] * 1500 + [0] * 1500), np.arange(3200)[:, None], 3200)
    assert found[:125].all() and not found[125:].any()


def test_words_of_near_copies_are_not_toxic():
    """Rare words that only near copies of a few toxic texts hold: copies with
    another word here and there count nearly as one."""
    rnd = np.random.default_rng(4)
    word = lambda: "".join(rnd.choice(list("abcdefgh"), 7))
    clean = [" ".join(word() for _ in range(30)) for _ in range(600)]
    base = [[word() for _ in range(40)] for _ in range(5)]
    toxic = []
    for i in range(600):
        w = list(base[i % 5]) if i < 60 else [word() for _ in range(20)]
        w[rnd.integers(10) if i < 60 else 3] = word()  # copies differ in their first words
        toxic.append(" ".join([*w[:5], f"scumm{i % 3}", *w[5:]]) if i % 5 else " ".join([*w, "scumm1"]))
    model = toxicity.fit(clean + toxic, [0] * 600 + [1] * 600)
    assert max(model.emission(x.encode()) for w in base for x in w[10:]) < 1 < model.emission(b"scumm0")
    fresh = [" ".join([*(word() for _ in range(30)), base[k % 5][20]]) for k in range(50)]
    assert (toxicity.score_texts(model, fresh)[0] < 0.7).all()
    assert (toxicity.score_texts(model, [t + " scumm2 here" for t in fresh])[0] >= 0.7).all()


def test_different_values_of_each_place():
    places = [np.array([0, 2, 2], np.int32), np.array([2, 0, 2], np.int32)]
    values = [np.array([-1, 7, 1 << 62]), np.array([7, -1, 5])]
    assert toxicity._different(places, values, 4).tolist() == [1, 0, 3, 0]
