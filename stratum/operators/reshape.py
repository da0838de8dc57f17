"""Wide -> long goals: one ``<prefix>YYYY`` column per year becomes
``(entity, period, value)``, consolidated per (entity, period)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import to_double_or_null, year_from_suffix


class NoGoalColumnsError(ValueError):
    """The goal table has none of the expected yearly columns."""


def goal_columns(df: DataFrame, prefix: str, years: Iterable[int] | None = None) -> list[str]:
    pattern = re.compile(re.escape(prefix) + r"(\d{4})")
    wanted = None if years is None else {int(y) for y in years}
    found = []
    for c in df.columns:
        m = pattern.fullmatch(c)
        if m and (wanted is None or int(m.group(1)) in wanted):
            found.append(c)
    return found


def unpivot_years(wide: DataFrame, ids: list[str], prefix: str, *, period: str,
                  value: str, years: Iterable[int] | None = None) -> DataFrame:
    """Long form of the yearly columns; the year comes from the column name
    (a period column already in ``wide`` is ignored).  NULL values are kept.

    ``unpivot`` is a single scan feeding an ``Expand`` -- not one scan per
    year glued by a union.
    """
    cols = goal_columns(wide, prefix, years)
    if not cols:
        raise NoGoalColumnsError(f"no columns named {prefix}YYYY in {wide.columns}")
    typed = wide.select(*ids, *[to_double_or_null(c).alias(c) for c in cols])
    long = typed.unpivot(ids, cols, "_goal_column", value)
    return long.select(*ids, year_from_suffix("_goal_column").alias(period), value)


def consolidate_mean(long: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean per key over several source rows (e.g. networks), skipping NULLs;
    an all-NULL group keeps a NULL value."""
    return long.groupBy(*keys).agg(F.avg(value).alias(value))


def goals_long(wide: DataFrame, entity: str, prefix: str, *, period: str, value: str,
               years: Iterable[int] | None = None) -> DataFrame:
    long = unpivot_years(wide, [entity], prefix, period=period, value=value, years=years)
    return consolidate_mean(long, [entity, period], value)
