"""Raw-layer operators: weighted indicator and audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import weighted_share_pct
from stratum.spec import DEFAULT_SPEC, IndicatorSpec


def weighted_indicator(micro: DataFrame, keys: list[str], score: str, flag: str,
                       weight: str, *, score_out: str, rate_out: str,
                       flag_yes: str = "1", rate_decimals: int = 4) -> DataFrame:
    """Per key group: unweighted mean score and weighted share of ``flag = yes``.

    One partial + final hash aggregate: the map side folds every input
    partition to one row per key before the shuffle, so a key holding a large
    share of the rows costs no more shuffle than any other key.
    """
    return micro.groupBy(*keys).agg(
        F.avg(score).alias(score_out),
        weighted_share_pct(flag, weight, flag_yes, rate_decimals).alias(rate_out),
    )


def indicator_of(micro: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The raw indicator table of microdata with the spec's column names."""
    s = spec
    return weighted_indicator(micro, [s.entity, s.period], s.score_raw, s.flag_raw, s.weight_raw,
                              score_out=s.score, rate_out=s.rate, flag_yes=s.flag_yes, rate_decimals=s.rate_decimals)


# Fixed names of a state's sums.
SUMS = ("score_sum", "score_count", "weight_sum", "yes_sum")


def indicator_state(micro: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """What the weighted indicator of microdata is made of, per (entity,
    period): sum and number of scores, weight, and weight of yes.  Sums of
    parts of the microdata add up to those of the whole."""
    s = spec
    yes = F.when(F.col(s.flag_raw) == F.lit(s.flag_yes), F.col(s.weight_raw)).otherwise(F.lit(0))
    return micro.groupBy(s.entity, s.period).agg(
        F.sum(s.score_raw).alias("score_sum"), F.count(s.score_raw).alias("score_count"),
        F.sum(s.weight_raw).alias("weight_sum"), F.sum(yes).alias("yes_sum"))


def merged_states(states: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """One state per (entity, period) of the states of several parts."""
    return states.groupBy(spec.entity, spec.period).agg(*[F.sum(c).alias(c) for c in SUMS])


def indicator_of_state(state: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The indicator table that :func:`indicator_of` builds from the microdata."""
    s = spec
    return state.select(
        s.entity, s.period, F.try_divide("score_sum", "score_count").alias(s.score),
        F.round(F.try_divide(F.lit(100) * F.col("yes_sum"), F.col("weight_sum")), s.rate_decimals).alias(s.rate))


def with_audit(df: DataFrame, ingest_date: str, source: str, *,
               audit_date: str = "_dt_ingestao", audit_source: str = "_fonte",
               partition: str | None = "dt_ingestao") -> DataFrame:
    """Add the literal audit columns and, optionally, the date partition column."""
    cols = {audit_date: F.lit(ingest_date), audit_source: F.lit(source)}
    if partition:
        cols[partition] = F.lit(ingest_date).cast("date")
    return df.withColumns(cols)


class EmptySourceError(ValueError):
    """Raised when an extract has no rows; nothing is written."""
