"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over links (u, v), v < u: every node's neighbours are linked to
    its smallest neighbour; large-star moves the larger neighbours, small-star
    the smaller ones and the node itself."""
    e = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if larger:
        moved = e.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (u, v) of longs -> (node, root): the smallest node reachable,
    for every node that has a link.

    Each round is written to the shared folder, so a lost executor costs at
    most a round and the plan doesn't grow.  Rounds are about the logarithm of
    the longest path.  A hub's neighbours are an equi-join side that AQE
    splits; minima are combined before the shuffle.  Self-links and null ends
    are ignored; no link at all gives no row.  A path that has not settled after
    ``max_rounds`` rounds (longer than about 2**60 links) raises.
    """
    edges = (links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
             .where("u <> v").distinct())
    edges = materialize(spark, edges, "links")
    state = None
    for _ in range(max_rounds):
        edges = materialize(spark, _star(_star(edges, True), False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
