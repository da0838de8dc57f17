"""Registered queries of this subpackage: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import balltree, lm, mixing, negatives, packing, periodic, pii, projections, simhash, spans, suffixes, toxicity, warc
from stratum.llm.common import file_rows, fold, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).drop("payload")


@query
def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the folds other than 1 of ``crc32(doc_id) mod 3``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 3) == 1
    model = toxicity.train(spark, docs.where(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "offsets")


@query
def op3_ngram_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the folds other than 0 of ``crc32(doc_id) mod 10``."""
    docs = table(spark, sf_dir, "documents")
    return lm.train_and_score(spark, docs, fold("doc_id", 10) == 0)


@query
def op4_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


@query
def op5_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without sentences of repeated runs, and how many those were."""
    docs = file_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "file", "row")
    return spans.remove_repeats(spark, docs, count="n_removed", numbers=("file", "row"))


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced, and how many entities that were."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(spark, docs, count="n_entities")


@query
def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each use of a document in the mixture."""
    return mixing.mix(spark, table(spark, sf_dir, "documents"), details=True)


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


@query
def op9_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return balltree.exact_top_k(spark, vectors, vectors.where("id % 20 = 0"))


@query
def op10_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return projections.nearest(spark, vectors, vectors.where("id % 50 = 0"))


@query
def op11_shared_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row carries the next label; anchors are every hundredth."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return negatives.mine(spark, rows, rows.where("id % 100 = 0"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents get a periodic tail first."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), plant=True).drop("text")


@query
def op13_blockwise_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without bytes of repeated 100-byte strings."""
    docs = file_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "file", "row")
    return suffixes.remove_repeats(spark, docs, numbers=("file", "row")).drop("text")


ORACLE["op9_ball_tree_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 20
"""

ORACLE["op11_shared_list_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.x, c.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE["op13_blockwise_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM d)),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
g AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 100, true)::INT AS new FROM r),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, k),
t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM t JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

ORACLE["op1_warc_capture_index"] = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, url, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
o AS (
  SELECT digest, max(page_id) AS original FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN original <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> d.page_id THEN original END AS refers_to, coalesce(url, '') AS target_uri
FROM d LEFT JOIN o USING (digest)
"""

ORACLE["op7_temperature_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS tokens FROM documents),
p AS (SELECT source, sum(tokens)::BIGINT AS t FROM d GROUP BY source),
tot AS (SELECT sum(t)::DOUBLE AS total, min(t) FILTER (t > 0) AS least, max(t) AS most FROM p),
halved(i, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT i, lo, hi, (lo + hi) / 2 AS mid,
           (1 - (lo + hi) / 2) * (ln(most::DOUBLE) - ln(least::DOUBLE)) <= ln(2::DOUBLE) AS ok FROM halved, tot)
  WHERE i < 30),
w AS (SELECT source, t, hi AS a, total, most, CASE WHEN t > 0 THEN pow(t / total, hi) ELSE 0 END AS raw
      FROM p, tot, halved WHERE i = 30),
q AS (SELECT source, t, round(raw / n * (most / (pow(most / total, a) / n)))::BIGINT AS quota
      FROM w, (SELECT sum(raw) AS n FROM w)),
s AS (SELECT source, CASE WHEN t > 0 THEN quota // t ELSE 1 END AS passes, CASE WHEN t > 0 THEN quota % t ELSE 0 END AS part,
             greatest(1, least(65536, ceil(t / 1048576)))::BIGINT AS blocks FROM q),
x AS (SELECT d.*, passes, part, md5('stratum mixture|doc|' || doc_id) || lpad(tokens::VARCHAR, 20, '0') AS place,
             ('0x' || substr(md5('stratum mixture|block|' || doc_id), 1, 8))::BIGINT % blocks AS block
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
y AS (SELECT *, md5('stratum mixture|turn|' || coalesce(source, '') || '|' || block) AS turn FROM x),
b AS (SELECT source, turn, block, part, sum(tokens) AS size FROM y WHERE part > 0 GROUP BY ALL),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY turn, block ROWS UNBOUNDED PRECEDING) AS upto FROM b),
cut AS (SELECT source, turn AS at_turn, block AS at_block, part - upto + size AS room FROM c
        WHERE upto > part QUALIFY row_number() OVER (PARTITION BY source ORDER BY turn, block) = 1),
inside AS (SELECT y.source, place, room, sum(tokens) OVER (PARTITION BY y.source ORDER BY place) AS upto
           FROM y JOIN cut ON y.source IS NOT DISTINCT FROM cut.source AND block = at_block),
last AS (SELECT source, max(place) AS last FROM inside WHERE upto <= room GROUP BY source),
z AS (SELECT y.*, passes + CASE WHEN at_block IS NOT NULL AND ((turn, block) < (at_turn, at_block) OR block = at_block AND place <= last) THEN 1 ELSE 0 END AS times
      FROM y LEFT JOIN cut ON y.source IS NOT DISTINCT FROM cut.source LEFT JOIN last ON y.source IS NOT DISTINCT FROM last.source)
SELECT doc_id, source, unnest(range(1, times + 1)) AS pass, block, tokens FROM z
"""
