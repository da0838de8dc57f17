"""Passages go to their last sentence."""

import random

from stratum.llm import spans


def removed(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r.text for r in sorted(spans.remove_repeats(spark, df).collect())]


def said(rnd, *lengths):
    return " ".join(" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) + "." for n in lengths)


def test_an_exact_copy_becomes_empty(spark):
    rnd = random.Random(4)
    texts = [said(rnd, *lengths) for lengths in [(25, 5, 5, 5), (5, 5, 5, 25), (11, 10, 3), (30, 1, 30, 1), (40, 40, 2, 2)]]
    assert removed(spark, *texts, *texts) == texts + [""] * len(texts)


def test_a_passage_goes_to_its_last_sentence(spark):
    rnd = random.Random(5)
    planted = said(rnd, 25, 5, 5, 5)
    own = [(said(rnd, 8, 9), said(rnd, 9, 8)) for _ in range(6)]
    got = removed(spark, *[f"{a} {planted} {b}" for a, b in own])
    assert got == [f"{own[0][0]} {planted} {own[0][1]}"] + [f"{a} {b}" for a, b in own[1:]]


def every_run(text, run=spans.RUN, least=spans.LEAST_WORDS):
    """The least runs by trying all: those that no shorter one starts or ends."""
    parts = [" ".join(text[a:b].lower().split()) for a, b in spans.sentences(text)]
    enough = {(i, j) for j in range(len(parts) + 1) for i in range(j - run + 1)
              if sum(len(p.split()) for p in parts[i:j]) >= least}
    return {(i, j) for i, j in enough if (i, j - 1) not in enough or (i + 1, j) not in enough}


def test_runs_match_trying_all():
    rnd = random.Random(6)
    for _ in range(200):
        text = said(rnd, *[rnd.randrange(1, 30) for _ in range(rnd.randrange(0, 12))]) if rnd.random() < .95 else ""
        _, _, first, end = spans.runs(text)
        assert sorted(zip(first.tolist(), end.tolist())) == sorted(every_run(text))


def test_scripts_without_spaces(spark):
    rnd = random.Random(7)
    for low, high in ((0x4e00, 0x9000), (0xe01, 0xe2e), (0x3041, 0x3090)):
        solid = lambda n: "".join(chr(rnd.randrange(low, high)) for _ in range(n))
        marked = "".join(solid(15) + "。" for _ in range(4))
        long = solid(300)
        own = [solid(40) + "。" for _ in range(4)]
        got = removed(spark, own[0] + marked, own[1] + marked, own[2] + long, own[3] + long)
        assert got[0] == own[0] + marked and got[1].rstrip("。") == own[1].rstrip("。") and got[2] == own[2] + long
        assert got[3].startswith(own[3]) and len(got[3]) - len(own[3]) <= 30


def test_few_words_of_unpunctuated_passages_stay():
    """Passages of 51 words within unpunctuated text: whole misses and what stays."""
    rnd = random.Random(8)
    word = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    missed = stay = 0
    for _ in range(1000):
        planted, texts = word(51), []
        for _ in range(2):
            texts.append(" ".join(word(60) + planted + word(60)))
        seen = set(spans.runs(texts[0])[0].tolist())
        h, _, first, end = spans.runs(texts[1])
        gone = {k for x, i, j in zip(h.tolist(), first, end) if x in seen for k in range(i, j)}
        left = len(set(planted) & set(spans.without(texts[1], gone).split()))
        missed, stay = missed + (left == 51), stay + left
    assert missed <= 15 and stay / 1000 <= 11, (missed, stay)
