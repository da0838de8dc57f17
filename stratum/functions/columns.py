"""Reusable Column builders.

Every function returns a ``pyspark.sql.Column`` made of built-in expressions,
so they stay inside whole-stage codegen and Catalyst can push, prune and fold
around them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_or_null(c: str | Column) -> Column:
    """Cast to double; text that does not parse becomes NULL (ANSI-safe)."""
    return _col(c).try_cast("double")


def normalized_region(c: str | Column) -> Column:
    """Region code as ``upper(trim(code))``."""
    return F.upper(F.trim(_col(c)))


def weighted_share_pct(flag: str | Column, weight: str | Column, yes: str = "1",
                       decimals: int = 4) -> Column:
    """Aggregate: ``round(100 * sum(w where flag = yes) / sum(w), decimals)``.

    A NULL or non-matching flag counts 0 in the numerator, every weight counts
    in the denominator; a zero total weight gives NULL (``try_divide``).
    """
    w = _col(weight)
    hits = F.sum(F.when(_col(flag) == F.lit(yes), w).otherwise(F.lit(0)))
    return F.round(F.try_divide(F.lit(100) * hits, F.sum(w)), decimals)


def share_pct(condition: Column, denominator_condition: Column | None = None,
              decimals: int = 2) -> Column:
    """Aggregate: percentage of rows meeting ``condition`` among the rows that
    meet ``denominator_condition`` (all rows when omitted); NULL when none."""
    base = F.lit(True) if denominator_condition is None else denominator_condition
    num = F.count_if(base & condition)
    den = F.count_if(base)
    return F.round(F.try_divide(F.lit(100.0) * num, den), decimals)


def number(c: str | Column) -> Column:
    """The value, NaN as NULL."""
    v = _col(c)
    return F.when(~F.isnan(v), v)


def exact_mean(c: str | Column) -> Column:
    """Aggregate: mean of the values, NULL and NaN skipped; no value: NULL.

    The sum has two parts.  Of each value, what a decimal with 18 places holds
    goes into an exact sum: all of it, for values below 10**10 that are given
    with as many places, so the mean of such values does not depend on how rows
    are split over partitions or in what order sums merge.  What the decimal
    doesn't hold (places after the 18th, values of 10**10 and more) is summed
    as doubles, so no value is cut at any size.
    """
    v = number(c)
    held = F.coalesce(v.try_cast("decimal(28,18)"), F.when(v.isNotNull(), F.lit(0).cast("decimal(28,18)")))
    rest = F.sum(v - held.cast("double"))
    return F.try_divide(F.sum(held).cast("double") + rest, F.count(v))


def goal_hit(gap: str | Column) -> Column:
    """``gap >= 0``, with a NULL gap counted as a miss (False, not NULL)."""
    return F.coalesce(_col(gap) >= F.lit(0), F.lit(False))


def out_of_range(c: str | Column, low: float, high: float, tolerance: float) -> Column:
    """True when the value lies outside ``[low - tol, high + tol]``.

    NULL stays NULL (not counted by ``count_if``); NaN sorts above every
    number in Spark, so it is out of range.
    """
    v = _col(c)
    return (v < F.lit(low - tolerance)) | (v > F.lit(high + tolerance))


def year_from_suffix(c: str | Column) -> Column:
    """Four-digit year at the end of a column-name string, as int."""
    return F.regexp_extract(_col(c), r"(\d{4})$", 1).cast("int")


def entity_label(name: str | Column, entity: str | Column, region: str | Column) -> Column:
    """``coalesce(name, id) || ' (' || region || ')'``; NULL region -> NULL."""
    return F.concat(F.coalesce(_col(name), _col(entity).cast("string")),
                    F.lit(" ("), _col(region), F.lit(")"))
