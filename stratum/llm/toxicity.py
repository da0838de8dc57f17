"""Toxic spans and document scores by a linear-chain conditional random field.

The tags are 0 (clean) and 1 (toxic).  Labels exist for documents only, so the
training tokens are labelled first: within toxic training documents, tokens
whose word, or prefix, is found in a much larger share of toxic than of clean
ones are toxic; all other tokens are clean.  The field has weights for
transitions and for each token's word and prefixes, and is fitted by
gradient ascent on the likelihood, whose expectations are forward-backward
marginals.  Scoring runs forward-backward over whole documents; the tokens'
marginals give the offending offsets and, through a logistic link on their sum
and maximum, the document's score.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh, slices

THRESHOLD = 0.7
#: Bounds of the training sample, per class: documents, and bytes of text.
SAMPLE_DOCS = 1500
SAMPLE_BYTES = 5_000_000

#: ASCII letters, digits and all bytes beyond ASCII belong to words.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Tokens of a block in the two-level forward-backward.
_BLOCK = 64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_TABLE).split()


def features(word: bytes) -> tuple[bytes, ...]:
    """The word and its prefixes of 4 to 6 bytes."""
    return (b"w" + word, b"4" + word[:4], b"5" + word[:5], b"6" + word[:6])


@dataclass
class Model:
    """``weights``: emission weight of tag 1 against tag 0 by feature;
    ``start``, ``moves``: log potentials; ``link``: bias and weights of the
    document score; ``prior``: share of toxic documents."""

    weights: dict[bytes, float] = field(default_factory=dict)
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    link: np.ndarray | None = None
    prior: float = 0.0

    def emission(self, word: bytes) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(word))


def marginals(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray,
              pairs: bool = False):
    """P(tag 1) of every token of several documents laid end to end (``emit``:
    log potential of tag 1 less that of tag 0), by exact forward-backward.

    Documents are cut into blocks.  All blocks' 2x2 transfer products are
    formed side by side, the few block products of a document are chained, and
    a second sweep within blocks starts from the chained vectors.
    ``pairs``: also the expected transition counts and first-token marginals.
    """
    n_docs = len(lengths)
    blocks = -(-lengths // _BLOCK)
    n = int(blocks.sum())
    if not n:
        out = np.zeros(0)
        return (out, np.zeros((2, 2)), np.zeros(0)) if pairs else out
    doc_first = np.cumsum(blocks) - blocks  # first block of a document
    token_first = np.cumsum(lengths) - lengths
    token_doc = np.repeat(np.arange(n_docs), lengths)
    within = np.arange(len(emit)) - token_first[token_doc]
    row, col = doc_first[token_doc] + within // _BLOCK, within % _BLOCK
    e = np.zeros((_BLOCK, n))
    live = np.zeros((_BLOCK, n), bool)
    e[col, row] = np.clip(emit, -30, 30)
    live[col, row] = True
    w0, w1 = np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))  # the larger is 1
    a = np.exp(moves - moves.max())
    first = np.exp(start - start.max())
    opens = np.zeros(n, bool)
    opens[doc_first[blocks > 0]] = True
    # Transfer products P (from the tag before the block); the first token of a
    # document takes start weights instead of a move.
    p = np.zeros((2, 2, n))
    for t in range(_BLOCK):
        if t == 0:
            q0 = np.where(opens, first[0], 0) + np.where(opens, 0, a[:, :1])
            q1 = np.where(opens, first[1], 0) + np.where(opens, 0, a[:, 1:])
        else:
            q0 = p[:, 0] * a[0, 0] + p[:, 1] * a[1, 0]
            q1 = p[:, 0] * a[0, 1] + p[:, 1] * a[1, 1]
        q0, q1 = q0 * w0[t], q1 * w1[t]
        scale = 1 / np.maximum(np.maximum(q0, q1).max(axis=0), 1e-300)
        p[:, 0] = np.where(live[t], q0 * scale, p[:, 0])
        p[:, 1] = np.where(live[t], q1 * scale, p[:, 1])
    # Chain the blocks of each document, all documents side by side.
    f_in, b_out = np.full((2, n), 0.5), np.full((2, n), 0.5)
    most = int(blocks.max())
    for k in range(1, most):
        at = doc_first[blocks > k] + k
        v = f_in[0, at - 1] * p[0][:, at - 1] + f_in[1, at - 1] * p[1][:, at - 1]
        f_in[:, at] = v / v.sum(axis=0)
    for k in range(most - 1, 0, -1):
        at = doc_first[blocks > k] + k
        v = p[:, 0, at] * b_out[0, at] + p[:, 1, at] * b_out[1, at]
        b_out[:, at - 1] = v / v.sum(axis=0)
    # Forward and backward within the blocks.
    fwd = np.empty((_BLOCK, 2, n))
    x0, x1 = f_in
    for t in range(_BLOCK):
        y0, y1 = x0 * a[0, 0] + x1 * a[1, 0], x0 * a[0, 1] + x1 * a[1, 1]
        if t == 0:
            y0, y1 = np.where(opens, first[0], y0), np.where(opens, first[1], y1)
        y0, y1 = y0 * w0[t], y1 * w1[t]
        s = y0 + y1
        x0, x1 = np.where(live[t], y0 / s, x0), np.where(live[t], y1 / s, x1)
        fwd[t, 0], fwd[t, 1] = x0, x1
    post = np.empty((_BLOCK, n))
    expected = np.zeros((2, 2))
    b0, b1 = b_out
    for t in range(_BLOCK - 1, -1, -1):
        g0, g1 = fwd[t, 0] * b0, fwd[t, 1] * b1
        post[t] = g1 / (g0 + g1)
        z0, z1 = w0[t] * b0, w1[t] * b1
        if pairs:
            l0, l1 = (fwd[t - 1, 0], fwd[t - 1, 1]) if t else f_in
            m = np.stack([l0 * a[0, 0] * z0, l0 * a[0, 1] * z1, l1 * a[1, 0] * z0, l1 * a[1, 1] * z1])
            use = live[t] & ~opens if t == 0 else live[t]
            expected += (m / m.sum(axis=0))[:, use].sum(axis=1).reshape(2, 2)
        c0, c1 = a[0, 0] * z0 + a[0, 1] * z1, a[1, 0] * z0 + a[1, 1] * z1
        s = c0 + c1
        b0, b1 = np.where(live[t], c0 / s, b0), np.where(live[t], c1 / s, b1)
    out = post[col, row]
    return (out, expected, out[token_first[lengths > 0]]) if pairs else out


def _different(places: list[np.ndarray], values: list[np.ndarray], size: int) -> np.ndarray:
    """How many different values each of ``size`` places has."""
    kinds, kind = np.unique(np.concatenate(values), return_inverse=True)
    pairs = np.concatenate(places).astype(np.int64)
    pairs *= len(kinds)
    pairs += kind
    del kind
    pairs.sort()
    first = np.r_[True, pairs[1:] != pairs[:-1]]
    return np.bincount(pairs[first] // len(kinds), minlength=size)


def _toxic_features(docs: list[np.ndarray], labels: np.ndarray, of_word: np.ndarray, size: int, least: int = 3,
                    ratio: float = 15.1) -> np.ndarray:
    """Which of the ``size`` features (words and prefixes; ``of_word``: those of
    each word) are found, as a smoothed share, 20 times as often in toxic as in
    clean documents, and significantly so: in at least ``least`` toxic ones, and
    twice the log-likelihood ratio of their share against the smoothed clean one
    is over ``ratio`` (15.1: by chance one in 10,000).  There toxic documents
    with the same words around the feature's first place count once: near copies
    tell little more about it than one.  Documents with the same words count once."""
    seen, n = np.zeros((2, size)), np.zeros(2)
    places, around = [], []
    for words, y in {(d.tobytes(), int(y)) for d, y in zip(docs, labels)}:
        n[y] += 1
        words = np.frombuffer(words, np.int32)
        if len(words):
            found, first = np.unique(of_word[words].ravel(), return_index=True)
            seen[y, found] += 1
            if y:
                beside = np.r_[-1, words, -1].astype(np.int64) + 1
                at = first // of_word.shape[1]
                places.append(found.astype(np.int32))
                around.append((beside[at] << 32) + beside[at + 2])
    apart = _different(places, around, size) if places else np.zeros(size)
    n0, n1 = np.maximum(n, 1)
    p, p0 = apart / n1, (seen[0] + 0.5) / (n0 + 1)
    rest = np.maximum(1 - p, 1e-12)
    llr = 2 * n1 * (p * np.log(np.maximum(p, 1e-12) / p0) + (1 - p) * np.log(rest / (1 - p0)))
    return (apart >= least) & (seen[1] / n1 > 20 * (seen[0] + 0.5) / n0) & (llr > ratio)


def _link_inputs(post: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each document: 1, log(1 + sum of marginals), their maximum."""
    x = np.zeros((len(lengths), 3))
    x[:, 0] = 1
    full = lengths > 0
    at = (np.cumsum(lengths) - lengths)[full]
    if len(at):
        x[full, 1] = np.log1p(np.add.reduceat(post, at))
        x[full, 2] = np.maximum.reduceat(post, at)
    return x


def _groups(lengths: np.ndarray, tokens: int = 100_000) -> list[tuple[int, int, int, int]]:
    """Documents cut to groups of about so many tokens: first and last
    document, first and last token."""
    ends = np.r_[0, np.cumsum(lengths)]
    part = ends[:-1] // tokens
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    return [(int(i), int(j), int(ends[i]), int(ends[j])) for i, j in zip(cuts[:-1], cuts[1:])]


def _by_group(emit, lengths, groups, start, moves) -> np.ndarray:
    return np.concatenate([marginals(emit[a:b], lengths[i:j], start, moves) for i, j, a, b in groups])


def fit(texts: list[str | None], labels: list[int], prior: float | None = None, steps: int = 20) -> Model:
    """Fit on whole texts with document labels 0 and 1 (``prior``: share of 1
    where the texts come from; else that among them).  With one class only
    the model scores every text by the smoothed prior."""
    y = np.array(labels, dtype=int)
    share = (y.sum() + 0.5) / (len(y) + 1) if prior is None else prior
    if not len(y) or y.min() == y.max():
        return Model(prior=float(share))
    vocab: dict[bytes, int] = {}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], np.int32) for t in texts]
    lengths = np.array([len(d) for d in docs])
    token_word = np.concatenate(docs)
    names: dict[bytes, int] = {}
    of_word = np.array([names.setdefault(f, len(names)) for w in vocab for f in features(w)],
                       np.int64).reshape(-1, 4)
    hit = _toxic_features(docs, y, of_word, len(names))[of_word].any(axis=1)
    counts = np.bincount(of_word.ravel(), np.repeat(np.bincount(token_word, minlength=len(vocab)), 4))
    kept = counts >= 3  # rarer features share one place, without a weight
    index = {f: i for f, i in zip((f for f, k in names.items() if kept[k]), range(len(names)))}
    of_word = np.where(kept, np.cumsum(kept) - 1, len(index))[of_word]
    del names, docs
    target = hit[token_word] & np.repeat(y == 1, lengths)
    same_doc = np.ones(len(token_word), bool)
    same_doc[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    t = target.astype(np.int8)
    seen = np.zeros((2, 2))
    np.add.at(seen, (t[:-1][same_doc[1:]], t[1:][same_doc[1:]]), 1)
    firsts = target[~same_doc]
    start = np.log([max(1.0, (~firsts).sum()), max(0.5, firsts.sum())])
    start -= start.max()
    moves = np.log((seen + 0.5) / (seen + 0.5).sum(axis=1, keepdims=True))
    weights, power = np.zeros(len(index) + 1), np.full(len(index) + 1, 1e-3)
    on_word = np.bincount(token_word, target, len(vocab))
    groups = _groups(lengths)
    for step in range(steps):  # AdaGrad on the mean penalised log-likelihood
        emit = weights[of_word].sum(axis=1)[token_word]
        if step % 5 == 4:
            parts = [marginals(emit[a:b], lengths[i:j], start, moves, True)[1:] for i, j, a, b in groups]
            expected, head = sum(e for e, _ in parts), np.concatenate([h for _, h in parts])
            moves = moves + 0.2 * (np.log(seen + 0.5) - np.log(expected + 0.5))
            start = start + 0.2 * np.log([((~firsts).sum() + 0.5) / (len(head) - head.sum() + 0.5),
                                          (firsts.sum() + 0.5) / (head.sum() + 0.5)])
        post = _by_group(emit, lengths, groups, start, moves)
        by_word = on_word - np.bincount(token_word, post, len(vocab))
        grad = np.bincount(of_word.ravel(), np.repeat(by_word, 4), len(index) + 1) - 0.2 * weights
        grad[-1] = 0
        power += grad * grad
        weights += grad / np.sqrt(power)
    post = _by_group(weights[of_word].sum(axis=1)[token_word], lengths, groups, start, moves)
    x = _link_inputs(post, lengths)
    rate = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    link = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        mu = 1 / (1 + np.exp(-np.clip(x @ link, -30, 30)))
        grad = x.T @ (rate * (y - mu)) - 0.05 * link
        curve = (x * (rate * mu * (1 - mu))[:, None]).T @ x + 0.05 * np.eye(3)
        link = link + np.clip(np.linalg.solve(curve, grad), -2, 2)
    large = {f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 1e-3}
    return Model(large, start, moves, link, float(share))


def score_texts(model: Model, texts: list[str | None], cache: dict[bytes, float] | None = None,
                spans_over: float = 0.5) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Scores, and offsets (start, end in characters) of tokens whose marginal
    is over ``spans_over``, neighbours joined."""
    if model.link is None:
        return np.full(len(texts), model.prior), [[] for _ in texts]
    cache = {} if cache is None else cache
    docs = [words_of(t) for t in texts]
    words = set().union(*docs)
    if len(cache) + len(words) > 400_000:
        cache.clear()
    for w in words - cache.keys():
        cache[w] = model.emission(w)
    emit = np.fromiter((cache[w] for d in docs for w in d), float)
    return _scored(model, texts, docs, emit, spans_over)


def _scored(model, texts, docs, emit, spans_over):
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    post = marginals(emit, lengths, model.start, model.moves)
    z = _link_inputs(post, lengths) @ model.link
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    ends = np.cumsum(lengths)
    for i in np.unique(np.searchsorted(ends, np.flatnonzero(post > spans_over), "right")):
        on = post[ends[i] - lengths[i]:ends[i]] > spans_over
        last = -2
        for k, m in enumerate(_WORD.finditer(texts[i])):
            if on[k]:
                if last == k - 1:
                    spans[i][-1] = (spans[i][-1][0], m.end())
                else:
                    spans[i].append(m.span())
                last = k
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), spans


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
          sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic): rows with a null id or label, or one other
    than 0 and 1, take no part.  The class shares are counted over all of
    them.  The sample is, of each class, whole documents with different texts
    in the order of a hash of the text, while they fit the bounds; it is
    independent of how the tables are partitioned.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").distinct()
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"),
                        F.xxhash64("text").alias("h")).join(known, "doc_id")
    n = {r.toxic: r["count"] for r in sized.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return fit([], [], prior=(n.get(1, 0) + 0.5) / (sum(n.values()) + 1))
    picked = []
    for y in (0, 1):
        left = sample_bytes
        different = sized.where(F.col("toxic") == y).groupBy("h").agg(F.min(F.struct("doc_id", "n")).alias("r"))
        for r in different.select("h", "r.*").orderBy("h").limit(sample_docs).collect():
            if r.n <= left:
                left -= r.n
                picked.append((r.doc_id, r.h, y))
    ids = F.broadcast(spark.createDataFrame(picked, "doc_id long, h long, toxic int"))  # at most 2 * sample_docs
    prior = n[1] / sum(n.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted({(r.doc_id, r.toxic, r.text or "") for f in frames for r in f.itertuples()})
        model = fit([r[2] for r in rows], [r[1] for r in rows], prior)
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # the sample is bounded, so one task can fit it; the driver sees weights only
    # by id and text: ids with several texts bring in those of the sample only, repeated rows count once
    rows = (docs.select("doc_id", F.xxhash64("text").alias("h"), "text").join(ids, ["doc_id", "h"])
            .dropDuplicates(["doc_id", "h", "toxic"]).select("doc_id", "text", "toxic").repartition(1))
    return pickle.loads(rows.mapInPandas(run, "model binary").first().model)


def with_scores(df: DataFrame, model: Model, text: str = "text", score: str = "score",
                spans: str = "offsets") -> DataFrame:
    """All rows and columns of ``df`` and two more: the score (0 to 1) and the
    offending offsets, an array of (start, end).  A null or empty text has no
    token and is scored as such."""
    at = df.columns.index(text)
    kind = "array<struct<start:int,end:int>>"
    schema = df.select("*", F.lit(0.0).alias(score), F.lit(None).cast(kind).alias(spans)).schema
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, float] = {}
        for b in slices(batches, at):
            values, found = score_texts(shared.value, b.column(at).to_pylist(), cache)
            found = pa.array([[{"start": s, "end": e} for s, e in x] for x in found], arrow)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64()), found],
                                             [*b.schema.names, score, spans])

    return df.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score at or over the threshold."""
    score, spans = fresh(docs, "score"), fresh(docs, "offsets")
    scored = with_scores(docs, model, score=score, spans=spans)
    return scored.where(F.col(score) < threshold).select(*docs.columns)
