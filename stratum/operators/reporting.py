"""Report queries over the marts: KPIs, regional comparison, national
evolution, distribution histogram and the worst-gap top-k.

"Latest period" is always the table-wide max period, applied as a scalar
subquery filter (no eager action; on a table partitioned by period it is a
partition filter).  One-row aggregates that rows need (a mean, histogram
bounds) are attached by an equi-join on the period against a broadcast of
that single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import entity_label, exact_mean, goal_hit, number
from stratum.operators.marts import REGION_RATE
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

# KPI and report column names of the reference's dashboard.
TOTAL_ENTITIES = "total_municipios"
PERIOD_RANGE = "anos_cobertos"
NATIONAL_RATE = "percentual_medio_nacional"
NATIONAL_SCORE = "proficiencia_media_nacional"
HIT_SHARE = "pct_municipios_atingiu_meta"
LATEST = "ultimo_ano"
FIRST = "primeiro_ano"
MEAN_OF_REGIONS = "media_nacional"
ABOVE_MEAN = "acima_media"
LABEL = "rotulo"
RANGE_SEPARATOR = "–"


def latest_period(df: DataFrame, period: str) -> Column:
    return df.select(F.max(period)).scalar()


def at_latest(df: DataFrame, period: str) -> DataFrame:
    """Rows of the latest period (P12).  On a table partitioned by period the
    subquery becomes a partition filter."""
    return df.filter(F.col(period) == latest_period(df, period))


def coverage(ind: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Exact distinct entity count over all periods, first/last period and the
    ``first–last`` text."""
    s = spec
    return ind.agg(
        F.count_distinct(s.entity).alias(TOTAL_ENTITIES),
        F.min(s.period).alias(FIRST),
        F.max(s.period).alias(LATEST),
        F.concat_ws(RANGE_SEPARATOR, F.min(s.period).cast("string"),
                    F.max(s.period).cast("string")).alias(PERIOD_RANGE))


def national_means(ind: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Unweighted mean over the latest period's entity rows, NULLs skipped."""
    s = spec
    return at_latest(ind, s.period).agg(
        F.max(s.period).alias(LATEST),
        exact_mean(s.rate).alias(NATIONAL_RATE),
        F.avg(s.score).alias(NATIONAL_SCORE))


def hit_share(goal_vs: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Percent of latest-period rows whose goal was hit (no goal = missed);
    NULL when the period has no rows."""
    s = spec
    return at_latest(goal_vs, s.period).agg(
        F.max(s.period).alias(LATEST),
        (F.lit(100.0) * F.avg(F.col(s.hit).cast("int"))).alias(HIT_SHARE))


def kpi_summary(silver: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The six headline values in one aggregate over the integrated table
    (the marts are projections of it, so one pass serves all six)."""
    s = spec
    latest = latest_period(silver, s.period)
    now = F.col(s.period) == latest
    hit = goal_hit(F.col(s.rate) - F.col(s.goal)).cast("int")
    return silver.agg(
        F.count_distinct(s.entity).alias(TOTAL_ENTITIES),
        F.concat_ws(RANGE_SEPARATOR, F.min(s.period).cast("string"),
                    F.max(s.period).cast("string")).alias(PERIOD_RANGE),
        exact_mean(F.when(now, F.col(s.rate))).alias(NATIONAL_RATE),
        F.avg(F.when(now, F.col(s.score))).alias(NATIONAL_SCORE),
        (F.lit(100.0) * F.avg(F.when(now, hit))).alias(HIT_SHARE),
        F.max(s.period).alias(LATEST))


def kpi_summary_from_marts(ind: DataFrame, goal_vs: DataFrame,
                           spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The same six values from the stored marts (per-entity indicator and
    goal vs result), as a dashboard reading Gold computes them: one aggregate
    per mart, the two one-row results joined on the latest period."""
    s = spec
    latest = latest_period(ind, s.period)
    now = F.col(s.period) == latest
    left = ind.agg(
        F.count_distinct(s.entity).alias(TOTAL_ENTITIES),
        F.concat_ws(RANGE_SEPARATOR, F.min(s.period).cast("string"),
                    F.max(s.period).cast("string")).alias(PERIOD_RANGE),
        exact_mean(F.when(now, F.col(s.rate))).alias(NATIONAL_RATE),
        F.avg(F.when(now, F.col(s.score))).alias(NATIONAL_SCORE),
        F.max(s.period).alias(LATEST))
    right = goal_vs.filter(now).agg(
        (F.lit(100.0) * F.avg(F.col(s.hit).cast("int"))).alias(HIT_SHARE),
        latest.alias(LATEST))
    return left.join(right, LATEST, "left").select(
        TOTAL_ENTITIES, PERIOD_RANGE, NATIONAL_RATE, NATIONAL_SCORE, HIT_SHARE, LATEST)


def region_vs_mean(evolution: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC,
                   rate: str = REGION_RATE) -> DataFrame:
    """Latest-period regions, ascending by mean (NULLs last), with the mean of
    the region means and whether each region is at or above it.

    The mean is a one-row aggregate attached by an equi-join on the period
    (a broadcast of exactly one row), not a scalar subquery per use.
    """
    s = spec
    now = at_latest(evolution, s.period)
    mean = now.groupBy(s.period).agg(exact_mean(rate).alias(MEAN_OF_REGIONS))
    return (now.join(F.broadcast(mean), s.period)
               .select(s.region, s.region_name, s.period, rate, MEAN_OF_REGIONS,
                       F.coalesce(F.col(rate) >= F.col(MEAN_OF_REGIONS), F.lit(False)).alias(ABOVE_MEAN))
               .orderBy(F.asc_nulls_last(rate), F.asc_nulls_last(s.region)))


def national_evolution(evolution: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC,
                       rate: str = REGION_RATE) -> DataFrame:
    """Per period: mean of the (already rounded) region means."""
    s = spec
    return (evolution.groupBy(s.period).agg(exact_mean(rate).alias(rate))
                     .orderBy(s.period))


def latest_stats(ind: DataFrame, value: str, period: str) -> DataFrame:
    """One row: the latest period with min / max / mean of ``value`` in it
    (NULL and NaN skipped).  Per-period partial aggregates, then ``max_by``
    over the handful of periods -- one pass, whatever the row count."""
    v = number(value)
    per_period = ind.groupBy(period).agg(F.min(v).alias("lo"), F.max(v).alias("hi"),
                                         exact_mean(value).alias("mean"))
    latest = per_period.agg(F.max_by(F.struct(period, "lo", "hi", "mean"), period).alias("s"))
    return latest.select("s.*")


def _edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Edge ``i`` of ``bins`` equal-width bins over [lo, hi]: ``i * step + lo``,
    the last one exactly ``hi`` (the usual ``linspace`` construction)."""
    step = (hi - lo) / F.lit(float(bins))
    return F.when(i == F.lit(bins), hi).otherwise(i.cast("double") * step + lo)


def bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based bin of ``v`` in [lo, hi]: scaled floor, then corrected against
    the edges so that a value on an inner edge goes to the upper bin and the
    last bin is closed -- the same result as the common array-library
    histogram, also where floating-point scaling lands just off an edge."""
    norm = F.lit(float(bins)) / (hi - lo)
    i0 = F.floor((v - lo) * norm).cast("int")
    i0 = F.when(i0 == F.lit(bins), F.lit(bins - 1)).otherwise(i0)
    i1 = F.when(v < _edge(i0, lo, hi, bins), i0 - 1).otherwise(i0)
    i2 = F.when((v >= _edge(i1 + 1, lo, hi, bins)) & (i1 != F.lit(bins - 1)), i1 + 1).otherwise(i1)
    return i2 + 1


def histogram(spark: SparkSession, ind: DataFrame, value: str, period: str, bins: int = 24) -> DataFrame:
    """Equal-width histogram of the latest period's values, NULL and NaN dropped.

    Edges span [min, max] (widened by 0.5 each side when min == max); a value
    on an inner edge goes to the upper bin and the last bin is closed.  Every
    bin is returned, empty ones with count 0, plus the mean of the values.

    Plan: the latest period is a scalar-subquery filter (a partition filter
    on a table partitioned by period); one aggregate over those rows gives
    the bounds (exactly one row), attached to the values by an equi-join on
    the period against a broadcast of that row; a partial aggregate counts
    per bin; the bin list is the same row exploded into ``bins`` rows.
    """
    now = at_latest(ind, period)
    stats = latest_stats(now, value, period)
    same = F.col("lo") == F.col("hi")
    edges = stats.select(period,
                         F.when(same, F.col("lo") - F.lit(0.5)).otherwise(F.col("lo")).alias("_lo"),
                         F.when(same, F.col("hi") + F.lit(0.5)).otherwise(F.col("hi")).alias("_hi"),
                         "mean")
    lo, hi = F.col("_lo"), F.col("_hi")
    # the same one-row frame feeds both sides, so it is computed once
    vals = now.select(period, value).filter(number(value).isNotNull()).join(F.broadcast(edges), period)
    counts = (vals.select(bin_index(F.col(value), lo, hi, bins).alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = edges.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), period, "_lo", "_hi", "mean")
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        _edge(F.col("bin") - 1, lo, hi, bins).alias("bin_start"),
                        _edge(F.col("bin"), lo, hi, bins).alias("bin_end"),
                        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
                        "mean"))


def worst_gap_topk(goal_vs: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC, k: int = 10) -> DataFrame:
    """The ``k`` latest-period rows furthest below their goal (smallest gap),
    NULL and NaN gaps dropped, ascending, ties broken by entity id.  Planned as a
    per-partition top-k plus a final merge (``TakeOrderedAndProject``), never
    a global sort."""
    s = spec
    rows = at_latest(goal_vs, s.period).filter(number(s.gap).isNotNull())
    return (rows.select(s.entity, s.entity_name, s.region, s.period, s.gap,
                        entity_label(s.entity_name, s.entity, s.region).alias(LABEL))
                .orderBy(F.col(s.gap).asc(), F.col(s.entity).asc())
                .limit(k))
