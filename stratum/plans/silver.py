"""Silver assembly: clean -> normalise -> flag -> unpivot goals -> join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.cleaning import clean, flag_missing, normalize_keys
from stratum.operators.integrate import attach_dimension, attach_goals
from stratum.operators.reshape import goals_long
from stratum.spec import DEFAULT_SPEC, IndicatorSpec


def prepare(df: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Cleaning then key normalisation, in that order (dedup sees raw keys)."""
    s = spec
    return normalize_keys(clean(df, s.cleaning_keys), entity=s.entity, region=s.region, period=s.period)


def silver_columns(spec: IndicatorSpec = DEFAULT_SPEC) -> list[str]:
    s = spec
    return [s.entity, s.entity_name, s.region, s.region_name, s.period, s.score, s.rate,
            s.goal, s.null_flag(s.score), s.null_flag(s.rate)]


def build_silver(indicator: DataFrame, dimension: DataFrame, goals_wide: DataFrame,
                 spec: IndicatorSpec = DEFAULT_SPEC, *, goal_years: Iterable[int] | None = None,
                 processed_at: bool = True) -> DataFrame:
    """One row per indicator row, with entity attributes and the goal.

    Both joins are LEFT joins keyed on fact columns, so their order does not
    change the result; goals go first because fact and goals are both
    partitioned by (entity, period) after their group-bys and meet without a
    new shuffle.
    """
    s = spec
    fact = flag_missing(prepare(indicator, s), s.metrics, s.null_flag_suffix)
    dim = prepare(dimension, s)
    goals = goals_long(prepare(goals_wide, s), s.entity, s.goal_prefix,
                       period=s.period, value=s.goal, years=goal_years)
    joined = attach_goals(fact, goals, [s.entity, s.period])
    joined = attach_dimension(joined, dim, s.entity, columns={
        s.region: s.region, s.region_name: s.region_name, s.dim_name: s.entity_name})
    out = joined.select(*silver_columns(s))
    if processed_at:
        out = out.withColumn(s.processed_at, F.current_timestamp())
    return out
