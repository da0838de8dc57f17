"""The five stages in a row on odd tables."""

import corpus_pipeline
from stratum.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid long, tokens long, block string"


def run(spark, docs, labels):
    base = scratch_path(spark, "odd")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return corpus_pipeline.run(spark, base)


def doc(i, text, source="web"):
    return (i, text, "en", source, len(text) if text is not None else None, 7, 8, "9")


def test_odd_documents(spark):
    clean = ["the river runs past the old mill and into the sea", "a list of tools that a small shop should keep",
             "she wrote three letters about the weather in May", "bread is baked at night and sold in the morning"]
    docs = [doc(i, clean[i % 4] + f" number {i} of the set {i * i}") for i in range(40)]
    docs += [doc(100 + i, f"awful slurzz and hatezz talkzz {i} badzz{i % 3} slurzz everywhere hatezz") for i in range(20)]
    docs += [doc(200, None), doc(201, ""), doc(202, None, None), doc(None, "no id but with some words in it"), doc(203, "Mr Adam Smith met Dr Xu"),
             doc(204, (" ".join(clean) + " ") * 1_500, "long"), doc(205, docs[0][1]), doc(206, docs[0][1]), doc(206, docs[0][1]), doc(207, " \n\t ")]
    docs += [doc(300 + i, (" ".join(clean[i:] + clean[:i]) + f" {i} ") * 700, "long") for i in range(4)]
    labels = [(i, 1, 0) for i in [*range(40), 204, 301, 302, 303]] + [(100 + i, 0, 1) for i in range(20)] + [(None, 1, 1), (300, 1, None)]  # long texts among the clean ones
    out = run(spark, docs, labels).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert not set(by_doc) & set(range(100, 120))  # rejected
    assert {200, 203, 204, None} <= set(by_doc) and len({0, 205, 206} & set(by_doc)) == 1  # one of the copies, and of the empty ones
    assert not {201, 202, 207} & set(by_doc)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in used.values():  # gapless, at most 2,048
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in by_doc[204] if r.start < 2048) >= 2048


def test_no_documents(spark):
    assert run(spark, [], []).count() == 0


def test_only_empty_documents(spark):
    out = run(spark, [doc(1, None), doc(2, "")], []).collect()
    assert {r.doc_id for r in out} == {1} and all(r.length == 1 for r in out)
