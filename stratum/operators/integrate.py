"""Silver integration: left joins of the fact to goals and to the dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_goals(fact: DataFrame, goals: DataFrame, keys: list[str]) -> DataFrame:
    """LEFT join on the composite (entity, period) key; no goal -> NULL.

    The goals come out of a group-by on the same keys, so that side is
    already hash-partitioned for this join and is not shuffled again.
    """
    return fact.join(goals, keys, "left")


def attach_dimension(fact: DataFrame, dim: DataFrame, entity: str, *, columns: dict[str, str]) -> DataFrame:
    """LEFT join on the entity key, taking ``columns`` (source -> output name).

    Unmatched entities get NULL attributes.  The join strategy is left to the
    optimizer: a dimension below ``spark.sql.autoBroadcastJoinThreshold``
    (checked from plan statistics, and again at run time by AQE) is
    broadcast, a larger one goes through a sort-merge join.
    """
    side = dim.select(entity, *[F.col(src).alias(out) for src, out in columns.items()])
    return fact.join(side, entity, "left")
