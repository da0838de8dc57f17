"""Silver cleaning: full-row dedup, all-NULL-key drop, key normalisation and
missing-metric flags.  Each step skips columns the input does not have."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratum.functions import normalized_region, to_double_or_null


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows over *all* columns (audit columns included).

    Runs before key normalisation on purpose: rows that differ only by case or
    padding of a key survive here and are caught by the duplicate check.
    """
    return df.dropDuplicates()


def drop_all_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop a row only when every present key column is NULL."""
    present = [k for k in keys if k in df.columns]
    return df.dropna(how="all", subset=present) if present else df


def clean(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return drop_all_null_keys(dedup_rows(df), keys)


def normalize_keys(df: DataFrame, *, entity: str | None = None, region: str | None = None,
                   period: str | None = None) -> DataFrame:
    """entity -> string, region -> upper(trim()), period -> int (fractions cut,
    also in text: ``'2024.0'`` is 2024; NULL if it is no number or too large);
    each only when the column is present."""
    cols = {}
    if entity and entity in df.columns:
        cols[entity] = F.col(entity).cast("string")
    if region and region in df.columns:
        cols[region] = normalized_region(region)
    if period and period in df.columns:
        value = F.col(period)
        cols[period] = value.try_cast("int")
        if isinstance(df.schema[period].dataType, StringType):  # else the partitioning by the period stays known
            cols[period] = F.coalesce(cols[period], value.try_cast("decimal(38,18)").try_cast("int"))
    return df.withColumns(cols) if cols else df


def flag_missing(df: DataFrame, metrics: Iterable[str], suffix: str = "_era_nulo") -> DataFrame:
    """Cast each present metric to double and add ``<metric><suffix>``.

    The flag is taken after the cast, so text that does not parse counts as
    missing.  No value is imputed.
    """
    cols = {}
    for m in metrics:
        if m not in df.columns:
            continue
        value = to_double_or_null(m)
        cols[m] = value
        cols[f"{m}{suffix}"] = value.isNull()
    return df.withColumns(cols) if cols else df
