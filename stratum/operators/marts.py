"""Gold marts derived from the integrated Silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import goal_hit
from stratum.spec import DEFAULT_SPEC, IndicatorSpec


def by_name(mart: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Ordered by (period, region, name).

    The entity id closes the sort key: it only orders ties, but it keeps the
    range partitioning of the global sort from putting every entity without
    a dimension row (NULL region and name) into a single task.
    """
    s = spec
    return mart.orderBy(s.period, s.region, s.entity_name, s.entity)


def by_region(mart: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Ordered by (region, period)."""
    return mart.orderBy(spec.region, spec.period)


def indicator_by_entity(silver: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC, *,
                        ordered: bool = True) -> DataFrame:
    """Per-entity indicator, :func:`by_name`."""
    s = spec
    out = silver.select(s.entity, s.entity_name, s.region, s.region_name, s.period, s.score, s.rate)
    return by_name(out, s) if ordered else out


def goal_vs_result(silver: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """gap = rate - goal; hit = gap >= 0 with a NULL gap counted as a miss."""
    s = spec
    gap = F.col(s.rate) - F.col(s.goal)
    return silver.select(
        s.entity, s.entity_name, s.region, s.period, s.rate, s.goal,
        gap.alias(s.gap), goal_hit(gap).alias(s.hit),
    )


# Output columns of the regional-evolution mart and the
# rounding of its means.
REGION_RATE = "percentual_alfabetizado_medio"
REGION_SCORE = "proficiencia_media_uf"
REGION_COUNT = "qtd_municipios"
REGION_DECIMALS = 2


def region_evolution(silver: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC, *,
                     ordered: bool = True) -> DataFrame:
    """Per (region, region name, period): unweighted means rounded to 2 and
    the number of non-NULL entity rows."""
    s = spec
    out = silver.groupBy(s.region, s.region_name, s.period).agg(
        F.round(F.avg(s.rate), REGION_DECIMALS).alias(REGION_RATE),
        F.round(F.avg(s.score), REGION_DECIMALS).alias(REGION_SCORE),
        F.count(s.entity).alias(REGION_COUNT),
    )
    return by_region(out, s) if ordered else out
