"""The pipeline's stages, each against what it was given."""

import collections

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from stratum.llm import mixing, packing, pii, toxicity
from test_packing import check
from test_simhash import slow_classes, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()
    ops = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in ops) == list(range(1, 14))


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage does its whole work on all rows of the one before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out[name] = docs.collect()
        assert k == 4 or docs.columns == columns
    given = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    # toxicity: the scorer run on one text at a time
    model = toxicity.train(spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [r for r in given if toxicity.score_texts(model, [r.text])[0][0] < toxicity.THRESHOLD]
    assert sorted(out["toxicity"]) == sorted(kept)
    assert sum(labels.get(r.doc_id, 0) for r in kept) <= 0.5 * sum(labels.values())  # 11 to learn from here
    assert sum(labels.get(r.doc_id) == 0 for r in kept) >= 0.95 * sum(v == 0 for v in labels.values())
    # near duplicates: all pairs
    root = slow_classes([(r.doc_id, slow_fingerprint(r.text)) for r in kept])
    kept = [r for r in kept if root[r.doc_id] == r.doc_id]
    assert sorted(out["simhash_near_dedup"]) == sorted(kept)
    # personal data: only entities differ
    import regex
    word = regex.compile(pii.PATTERN)
    new = {r.doc_id: r for r in out["pii"]}
    assert new.keys() == {r.doc_id for r in kept}
    for r in kept:
        assert word.split(r.text) == word.split(new[r.doc_id].text)
        assert not set(word.findall(r.text)) & set(word.findall(new[r.doc_id].text))
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)
    # mixing: every document, as often as its source's passes say
    used = collections.Counter(r.doc_id for r in out["mixing"])
    assert used.keys() == new.keys() and all(new[r.doc_id] == r for r in out["mixing"])
    per = collections.defaultdict(lambda: [0, 0])
    for r in out["pii"]:
        n = len(r.text.split())
        per[r.source][0] += n
        per[r.source][1] += n * used[r.doc_id]
    assert all(1 <= b / a <= mixing.MAX_REPEAT + 1e-9 for a, b in per.values())
    # packing: exact pieces
    tok = Tokenizer.from_file(str(public_tokenizers.path(packing.TOKENIZER)))
    tok.encode_special_tokens = True
    assert check(out["packing"], [(r.doc_id, r.text) for r in out["mixing"]], packing.LENGTH, tok) > 0.97


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
