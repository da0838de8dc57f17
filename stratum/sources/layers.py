"""Silver and Gold storage.

Silver is partitioned by (period, region) and read back with an explicit
schema, so partition columns keep their types (a numeric-looking region code
stays a string) and a NULL region comes back as NULL.  Both layers are published by
version (:mod:`stratum.sources.versions`): a path here is the layer's base, and
readers resolve its current version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratum.sources.versions import current, publish
from stratum.spec import DEFAULT_SPEC, IndicatorSpec


def silver_schema(spec: IndicatorSpec = DEFAULT_SPEC, *, processed_at: bool = True) -> T.StructType:
    s = spec
    fields = [
        T.StructField(s.entity, T.StringType()),
        T.StructField(s.entity_name, T.StringType()),
        T.StructField(s.region_name, T.StringType()),
        T.StructField(s.score, T.DoubleType()),
        T.StructField(s.rate, T.DoubleType()),
        T.StructField(s.goal, T.DoubleType()),
        T.StructField(s.null_flag(s.score), T.BooleanType()),
        T.StructField(s.null_flag(s.rate), T.BooleanType()),
    ]
    if processed_at:
        fields.append(T.StructField(s.processed_at, T.TimestampType()))
    # partition columns come last on read
    fields += [T.StructField(s.period, T.IntegerType()), T.StructField(s.region, T.StringType())]
    return T.StructType(fields)


def by_partition(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows dealt to tasks for a partitioned write.

    The ``rebalance`` hint shuffles rows by the partition columns so each
    directory gets few files, and lets AQE split a hot partition value over
    several tasks (and merge tiny ones) instead of one task per value.
    """
    return df.hint("rebalance", *partition_cols)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], *, dealt: bool = False) -> str:
    """Full overwrite, Hive-style partitions, whatever the session's overwrite
    mode: partitions of earlier runs go.  ``dealt``: the rows come from
    :func:`by_partition` already."""
    rows = df if dealt else by_partition(df, partition_cols)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*partition_cols).parquet(path))
    return path


def silver_partitions(spec: IndicatorSpec = DEFAULT_SPEC) -> list[str]:
    return [spec.period, spec.region]


def write_silver(df: DataFrame, path: str, spec: IndicatorSpec = DEFAULT_SPEC, *, dealt: bool = False) -> str:
    """A new version of the whole table, current once it is written; a reader
    meanwhile, or after a write that failed, has the version before."""
    publish(df.sparkSession, path, lambda folder: write_partitioned(df, folder, silver_partitions(spec), dealt=dealt))
    return path


def read_silver(spark: SparkSession, path: str, spec: IndicatorSpec = DEFAULT_SPEC, *,
                processed_at: bool = True) -> DataFrame:
    """The current version; the DataFrame goes on reading it when another one
    is published."""
    return spark.read.schema(silver_schema(spec, processed_at=processed_at)).parquet(current(spark, path))


def write_gold(df: DataFrame, path: str) -> str:
    """Full overwrite, unpartitioned (row order of an ordered mart is kept)."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
