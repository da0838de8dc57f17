"""Temperature mixing of sources, realised as budgeted block permutations.

Shares ``p`` of the sources' tokens become weights ``p**a / sum(p**a)``.  The
exponent ``a`` in [0, 1] is bisected: the flattest mixture that repeats no
source more than a limit, or the one of a target entropy.  A source's budget is
filled with whole passes over its documents and then part of one more pass, in
which its blocks (documents dealt by a keyed hash) come in a keyed order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import fresh, materialize

KEY = "stratum mixture"
MAX_REPEAT = 2.0
BLOCK_TOKENS = 1 << 20
#: Blocks of a source at most: what orders a source's blocks stays this small.
MAX_BLOCKS = 1 << 16
#: Halvings of [0, 1], and how many of them one pass over the sources serves.
HALVINGS, PER_PASS = 30, 6


@dataclass(frozen=True)
class Mixture:
    """``sources``: (source, tokens, docs, weight, quota, passes, part): tokens
    budgeted, whole passes, and tokens of the last, partial pass."""

    exponent: float
    budget: float
    sources: DataFrame


def n_tokens(text: Column | str) -> Column:
    """Number of words (runs of anything but ASCII white space); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def _bisect(sources: DataFrame, total: float, entropy: float | None, max_repeat: float, least: float,
            most: float) -> float:
    """The exponent, from below by ``HALVINGS`` halvings."""
    def enough(a: float, sums: tuple[float, float] | None) -> bool:
        if entropy is None:  # repetition of the rarest source against the commonest
            return (1 - a) * (math.log(most) - math.log(least)) <= math.log(max(max_repeat, 1.0))
        s, t = sums  # of p ** a, and of p ** a * log(p); entropy falls as the exponent grows
        return math.log(s) - a * t / s <= entropy

    low, high = 0.0, 1.0
    for _ in range(HALVINGS // PER_PASS):
        grid = [low + (high - low) * k / 2**PER_PASS for k in range(1, 2**PER_PASS)]
        sums: list = [None] * len(grid)
        if entropy is not None:
            p = F.col("tokens") / F.lit(total)
            row = sources.where("tokens > 0").agg(*[x for a in grid for x in (
                F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))]).first()
            sums = list(zip(row[::2], row[1::2]))
        at, step = 0, 2**PER_PASS
        while step > 1:  # grid point k stands for low + k/64 of the interval
            step //= 2
            if not enough(grid[at + step - 1], sums[at + step - 1]):
                at += step
        width = (high - low) / 2**PER_PASS
        low, high = low + at * width, low + (at + 1) * width
    return high


def mixture(spark: SparkSession, docs: DataFrame, entropy: float | None = None, max_repeat: float = MAX_REPEAT,
            budget: float | None = None) -> Mixture:
    """Weights and budgets of the sources of ``docs`` (source, tokens).

    With ``entropy`` (nats) the exponent is the smallest whose mixture has at
    most that entropy; else the smallest by which no source is repeated more
    than ``max_repeat`` times as often as the least repeated one.  ``budget``:
    tokens of the mixture; by default just as many that the least repeated
    source is used once, so that no document is left out.  A null source is a
    source of its own.  Sources without a token have weight 0 and are passed
    over once.
    """
    per = docs.groupBy("source").agg(F.sum("tokens").cast("long").alias("tokens"), F.count("*").alias("docs"))
    per = materialize(spark, per, "mix-sources")
    total, least, most = per.where("tokens > 0").agg(
        F.sum("tokens").cast("double"), F.min("tokens"), F.max("tokens")).first()
    if not total:
        return Mixture(1.0, 0.0, per.selectExpr("*", "0D AS weight", "0L AS quota", "1L AS passes", "0L AS part"))
    a = _bisect(per, total, entropy, max_repeat, least, most)
    raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(a))).otherwise(F.lit(0.0))
    norm = per.agg(F.sum(raw)).first()[0]
    if budget is None:  # the commonest source is the least repeated
        budget = most / ((most / total) ** a / norm)
    sized = (per.withColumn("weight", raw / F.lit(norm))
             .withColumn("quota", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
             .withColumn("passes", F.expr("CASE WHEN tokens > 0 THEN quota div tokens ELSE 1 END"))
             .withColumn("part", F.expr("CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END")))
    return Mixture(a, float(budget), materialize(spark, sized, "mix-weights"))


def _key(key: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(key), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def mix(spark: SparkSession, docs: DataFrame, key: str = KEY, block_tokens: int = BLOCK_TOKENS,
        details: bool = False, **target) -> DataFrame:
    """The mixture of ``docs`` (doc_id, text, source, ...): its rows, each as
    often as its source's passes say (``target``: see :func:`mixture`).

    ``details``: (doc_id, source, pass, block, tokens) instead of the columns
    of ``docs``.  The last, partial pass of a source takes its blocks in keyed
    order while they fit the budget whole, and of the next one the documents
    in keyed order while they fit: the budget is never exceeded, and missed by
    less than the first document left out.

    What is taken of a partial pass is kept as one bound in that order for
    each source, so texts are never shuffled: rows are compared with the bound
    of their source.  A block holds at most 1/65536 of a source, or
    ``block_tokens``; only one block's documents of a source are sorted.
    Null ids and texts count as empty; an empty text costs nothing; rows of
    one id and size are taken or left together; other columns play no part.
    """
    names = {n: fresh(docs, n) for n in
             ("tokens", "block", "of", "passes", "blocks", "cut", "room", "last", "pass")}
    sized = docs.withColumn(names["tokens"], n_tokens(docs["text"]))
    narrow = sized.select("doc_id", "source", F.col(names["tokens"]).alias("tokens"))
    sources = mixture(spark, narrow.select("source", "tokens"), **target).sources
    plan = sources.select(F.col("source").alias("of"), "passes", "part", F.greatest(F.lit(1), F.least(
        F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / F.lit(block_tokens)))).cast("long").alias("blocks"))

    def block(blocks: str) -> Column:
        head = F.conv(F.substring(_key(key, F.lit("block"), F.col("doc_id")), 1, 8), 16, 10)
        return F.pmod(head.cast("long"), F.col(blocks))

    turn = F.struct(_key(key, F.lit("turn"), F.col("source"), F.col("block")).alias("turn"), F.col("block"))
    order = F.struct(_key(key, F.lit("doc"), F.col("doc_id")).alias("h"), F.col("tokens"))
    small = narrow.join(plan.where("part > 0"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "doc_id", "tokens", "part", block("blocks").alias("block"))
    small = materialize(spark, small, "mix-narrow")
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    cut = (small.groupBy("source", "block", "part").agg(F.sum("tokens").alias("size"))
           .select("source", "part", "size", turn.alias("turn")).withColumn("upto", upto).where("upto > part")
           .groupBy("source").agg(F.min(F.struct("turn", F.expr("part - upto + size").alias("room"))).alias("x"))
           .select(F.col("source").alias("s"), F.col("x.turn").alias("cut"), "x.room"))
    cut = materialize(spark, cut, "mix-cuts")
    upto = F.sum("tokens").over(Window.partitionBy("s").orderBy("order"))
    last = (small.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("cut.block")))
            .select("s", "tokens", "room", order.alias("order")).withColumn("upto", upto).where("upto <= room")
            .groupBy("s").agg(F.max("order").alias("last")).withColumnRenamed("s", "z"))
    plan = (plan.join(cut, F.col("of").eqNullSafe(F.col("s")), "left").drop("s")
            .join(last, F.col("of").eqNullSafe(F.col("z")), "left"))
    plan = materialize(spark, plan.select(*[F.col(c).alias(names[c]) for c in ("of", "passes", "blocks", "cut", "last")]),
                       "mix-plan")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col(names["of"]))).withColumn(
        names["block"], block(names["blocks"]))
    turn = F.struct(_key(key, F.lit("turn"), F.col("source"), F.col(names["block"])).alias("turn"),
                    F.col(names["block"]).alias("block"))
    order = F.struct(_key(key, F.lit("doc"), F.col("doc_id")).alias("h"), F.col(names["tokens"]).alias("tokens"))
    more = (turn < F.col(names["cut"])) | ((turn == F.col(names["cut"])) & (order <= F.col(names["last"])))
    times = F.col(names["passes"]) + F.coalesce(more, F.lit(False)).cast("long")
    rows = rows.withColumn(names["pass"], F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("long"), times))))
    if details:
        return rows.select("doc_id", "source", F.col(names["pass"]).alias("pass"),
                           F.col(names["block"]).alias("block"), F.col(names["tokens"]).alias("tokens"))
    return rows.select(*docs.columns)
