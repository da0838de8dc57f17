"""The weighted indicator, kept up to date by day.

Microdata arrives in daily parts.  Of each day only its *state* is kept: the
sums per (entity, period) that the indicator is made of, a folder for each day.
The merged state of all days is published by version with the list of days in
it.  A new day is aggregated alone and added to the merged state: neither the
microdata nor the states of earlier days are read.  A day that comes again
(a rerun or a correction) replaces its own state, and the merged state is made
anew from the daily states; microdata of other days is never needed again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.bronze import EmptySourceError, indicator_of_state, indicator_state, merged_states
from stratum.sources.files import read_file, write_file
from stratum.sources.versions import current, is_published, publish
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

DAY = "dia"
DAYS = "days.json"


def _daily(base: str) -> str:
    return f"{base.rstrip('/')}/daily"


def _merged(base: str) -> str:
    return f"{base.rstrip('/')}/merged"


def days(spark: SparkSession, base: str) -> list[str]:
    """The days that the current merged state holds."""
    if not is_published(spark, _merged(base)):
        return []
    return json.loads(read_file(spark, f"{current(spark, _merged(base))}/{DAYS}"))


def _publish(spark: SparkSession, base: str, state: DataFrame, held: list[str]) -> None:
    def write(folder: str) -> None:
        state.write.parquet(f"{folder}/state")
        write_file(spark, f"{folder}/{DAYS}", json.dumps(sorted(held)).encode())

    publish(spark, _merged(base), write)


def add_day(spark: SparkSession, base: str, day: str, micro: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> list[str]:
    """Add a day's microdata and return the days that are in now.

    The day's state is written first, replacing the day's folder if there is
    one; if the run dies before the merged state is published, running it again
    gives the same.  A day without a row raises and changes nothing.
    """
    held = days(spark, base)
    state = indicator_state(micro, spec).withColumn(DAY, F.lit(day))
    (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(_daily(base)))
    daily = spark.read.option("basePath", _daily(base))
    if not _has(spark, base, day):
        raise EmptySourceError(f"no microdata for day '{day}'; nothing added")
    if day in held:  # all daily states of the days that are in
        parts = daily.parquet(*[f"{_daily(base)}/{DAY}={d}" for d in held]).drop(DAY)
    else:
        parts = daily.parquet(f"{_daily(base)}/{DAY}={day}").drop(DAY)
        if held:
            parts = parts.unionByName(read_state(spark, base))
        held = [*held, day]
    _publish(spark, base, merged_states(parts, spec), held)
    return sorted(held)


def _has(spark: SparkSession, base: str, day: str) -> bool:
    from stratum.sources.files import names
    return bool(names(spark, f"{_daily(base)}/{DAY}={day}"))


def read_state(spark: SparkSession, base: str) -> DataFrame:
    """The merged state of all days."""
    return spark.read.parquet(f"{current(spark, _merged(base))}/state")


def read_indicator(spark: SparkSession, base: str, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """The indicator of all days' microdata, a projection of the merged state."""
    return indicator_of_state(read_state(spark, base), spec)
