"""Logical table name -> lazy reader of the raw source (read whole)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stratum.operators.bronze import indicator_of
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

Loader = Callable[[SparkSession], DataFrame]


class SourceRegistry:
    """Maps logical keys to loaders; ``select("all")`` gives every key.

    A loader is any ``spark -> DataFrame``: a ``spark.read.format(...)`` of a
    path, a table, or a query over other tables.  Nothing is read until the
    returned DataFrame runs.
    """

    def __init__(self, loaders: dict[str, Loader] | None = None):
        self._loaders: dict[str, Loader] = dict(loaders or {})

    def add(self, key: str, loader: Loader) -> SourceRegistry:
        self._loaders[key] = loader
        return self

    def add_path(self, key: str, path: str, fmt: str = "parquet", **options) -> SourceRegistry:
        return self.add(key, lambda spark: spark.read.format(fmt).options(**options).load(path))

    def add_microdata(self, key: str, path: str, fmt: str = "parquet", *,
                      spec: IndicatorSpec = DEFAULT_SPEC, **options) -> SourceRegistry:
        """A source of single observations: reading it builds the weighted
        indicator per entity and period."""
        return self.add(key, lambda spark: indicator_of(spark.read.format(fmt).options(**options).load(path), spec))

    def add_daily(self, key: str, base: str, spec: IndicatorSpec = DEFAULT_SPEC) -> SourceRegistry:
        """A source of microdata that is added by day (:mod:`stratum.plans.incremental`):
        reading it aggregates nothing."""
        from stratum.plans.incremental import read_indicator
        return self.add(key, lambda spark: read_indicator(spark, base, spec))

    def keys(self) -> list[str]:
        return list(self._loaders)

    def select(self, key: str) -> list[str]:
        if key == "all":
            return self.keys()
        if key not in self._loaders:
            raise KeyError(f"unknown source '{key}'; known: {self.keys()}")
        return [key]

    def read(self, spark: SparkSession, key: str) -> DataFrame:
        return self._loaders[key](spark)

    def read_many(self, spark: SparkSession, keys: Iterable[str]) -> dict[str, DataFrame]:
        return {k: self.read(spark, k) for k in keys}

    def read_union(self, spark: SparkSession, keys: Iterable[str], *,
                   allow_missing_columns: bool = False) -> DataFrame:
        """Several sources of the same table as one DataFrame (UNION ALL by
        column name; no shuffle)."""
        frames = [self.read(spark, k) for k in keys]
        if not frames:
            raise ValueError("no sources to union")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing_columns), frames)
