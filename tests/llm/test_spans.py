"""Sentence-run removal against a dictionary of runs."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import spans
from stratum.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def slow(rows, run=spans.RUN, least=spans.LEAST_WORDS):
    """(doc_id, text) in the order of ids -> texts without repeats: from every
    sentence on, and up to every sentence, the shortest run that is long enough."""
    first, out = set(), {}
    for i, text in rows:
        marks = spans.sentences(text or "")
        parts = [" ".join(text[a:b].lower().split()) for a, b in marks]
        words = [len(p.split()) for p in parts]

        def enough(a, b):
            return b - a >= run and sum(words[a:b]) >= least

        spots = set()
        for k in range(len(parts)):
            spots |= {(k, b) for b in range(k + 1, len(parts) + 1) if enough(k, b) and not enough(k, b - 1)}
            spots |= {(a, k + 1) for a in range(k + 1) if enough(a, k + 1) and not enough(a + 1, k + 1)}
        gone = set()
        for a, b in sorted(spots):
            if tuple(parts[a:b]) in first:
                gone.update(range(a, b))
            first.add(tuple(parts[a:b]))
        out[i] = (text if not gone else "".join(text[a:b] for k, (a, b) in enumerate(marks) if k not in gone), len(gone))
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n\t", max_size=300) | st.lists(st.sampled_from(["w", "xy", "z."]), max_size=90).map(" ".join))
def test_sentences_tile_the_text(text):
    marks = spans.sentences(text)
    assert "".join(text[a:b] for a, b in marks) == text and all(a < b for a, b in marks)


def test_query_matches_dictionary(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.text, r.n_removed) for r in REGISTRY["op5_sentence_span_dedup"](spark, SF).collect()}
    assert got == slow(docs)
    assert sum(n > 0 for _, n in got.values()) > 5


def passage(rnd, sentences, words):
    return [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(words)) + "." for _ in range(sentences)]


def test_passages_with_and_without_full_stops(spark):
    rnd = random.Random(2)
    planted = " ".join(passage(rnd, 6, 10))
    long = " ".join(f"v{rnd.randrange(10**6)}" for _ in range(120))  # one sentence of 120 words
    rows = []
    for i in range(30):
        own = [passage(rnd, 4, 9), passage(rnd, 4, 9)]
        middle = {0: [planted], 1: [long + " end."]}.get(i % 3, [])
        rows.append((i, " ".join([*own[0], *middle, *own[1]])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.text for r in spans.remove_repeats(spark, df).collect()}
    for i, text in rows:
        if i % 3 == 2 or i in (0, 1):
            assert got[i] == text
        else:
            kept = set(got[i].split())
            inside = (planted if i % 3 == 0 else long).split()
            assert len([w for w in inside if w in kept]) <= (0 if i % 3 == 0 else 60)
            assert len(kept) >= 70


def test_edges(spark):
    text = ("One two three four five six seven. Eight nine ten eleven twelve thirteen fourteen. "
            "Fifteen sixteen seventeen eighteen nineteen twenty.\nTail here")
    rows = [(1, None), (2, ""), (3, "A. B. C. D."), (4, "A. B. C. D."), (5, text), (5, text), (6, text.upper() + " x"),
            (None, text), (7, "word " * 40000), (8, "no repeat. at all. in this. document.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS uid", "2 AS h", "3 AS starts", "4 AS pos")
    out = spans.remove_repeats(spark, df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[1] == [None] and got[2] == [""] and got[3] == got[4] == ["A. B. C. D."]
    # copies go to their last sentence; of a copy with another last word that sentence stays
    assert sorted(got[5]) == ["", text] and got[6] == ["TAIL HERE x"] and got[None] == [""]
    assert got[7] == ["word " * 40000] and got[8] == ["no repeat. at all. in this. document."]
    twice = spark.createDataFrame([(1, text + ". " + text)], "doc_id long, text string")
    assert spans.remove_repeats(spark, twice, count="n").first() == (1, text + ". Tail here", 3)
    assert spans.remove_repeats(spark, df.limit(0)).count() == 0
