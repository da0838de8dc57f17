"""Distinct entities over any periods, from stored sets.

Each entity has a code, (bucket, word, bit): the bucket by a hash, the place in
it by a dictionary that only grows, so codes are dense and no two entities share
one.  Of each period the set of its entities is kept as bitmaps of 32,768 codes.
Sets of periods are united by ``bitmap_or_agg`` and counted exactly; rows of
Silver are read once, when their period is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.sources.versions import current, is_published, publish
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

BITS = 32_768  # of a bitmap of Spark's bitmap functions
BUCKETS = 64
DICTIONARY, SETS = "dictionary", "sets"
# Fixed names of the results' columns.
DISTINCT, BY_PERIOD, AGAIN = "total_municipios", "municipios", "tambem_no_anterior"


def _bucket(entity: str, buckets: int):
    return F.pmod(F.xxhash64(entity), F.lit(buckets))


def _grown(known: DataFrame | None, rows: DataFrame, buckets: int) -> DataFrame:
    """(entity, bucket, place): the dictionary with entities of ``rows`` that it
    doesn't have behind those of their bucket."""
    new = rows.select("entity").where("entity IS NOT NULL").distinct()
    if known is None:
        new = new.withColumn("bucket", _bucket("entity", buckets)).withColumn("from", F.lit(0).cast("long"))
    else:
        last = known.groupBy("bucket").agg((F.max("place") + 1).alias("from"))
        new = (new.join(known.select("entity"), "entity", "left_anti").withColumn("bucket", _bucket("entity", buckets))
               .join(last, "bucket", "left").withColumn("from", F.coalesce("from", F.lit(0))))
    order = Window.partitionBy("bucket").orderBy("entity")
    new = new.select("entity", "bucket", (F.col("from") + F.row_number().over(order) - 1).cast("long").alias("place"))
    return new if known is None else known.unionByName(new)


def add_periods(spark: SparkSession, base: str, rows: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC,
                buckets: int = BUCKETS) -> None:
    """Add the entities of ``rows`` (or replace those of periods that are in
    already).  ``buckets``: as many as tasks are wanted for the dictionary; it
    is fixed by the first call.  NULL entities count nowhere, like in a distinct
    count; rows with a NULL period form a period of their own."""
    s = spec
    rows = rows.select(F.col(s.entity).cast("string").alias("entity"), F.col(s.period).alias("period"))
    before = current(spark, base) if is_published(spark, base) else None

    def write(folder: str) -> None:
        known = spark.read.parquet(f"{before}/{DICTIONARY}") if before else None
        size = buckets if known is None else spark.read.parquet(f"{before}/size").first().buckets
        spark.createDataFrame([(size,)], "buckets int").coalesce(1).write.parquet(f"{folder}/size")
        _grown(known, rows, size).write.parquet(f"{folder}/{DICTIONARY}")
        codes = spark.read.parquet(f"{folder}/{DICTIONARY}")
        periods = rows.select("period").distinct()
        own = rows.where("entity IS NOT NULL").distinct().join(codes, "entity")
        sets = own.groupBy("period", "bucket", F.expr(f"place div {BITS}").alias("word")).agg(
            F.bitmap_construct_agg((F.col("place") % BITS)).alias("bits"))
        if before:
            old = spark.read.parquet(f"{before}/{SETS}").alias("o")
            gone = periods.select(F.col("period").alias("again"))
            kept = old.join(gone, F.col("o.period").eqNullSafe(F.col("again")), "left_anti")
            sets = sets.unionByName(kept)
        sets.write.parquet(f"{folder}/{SETS}")

    publish(spark, base, write)


def read_sets(spark: SparkSession, base: str) -> DataFrame:
    """(period, bucket, word, bits) of all periods."""
    return spark.read.parquet(f"{current(spark, base)}/{SETS}")


def distinct_entities(sets: DataFrame) -> DataFrame:
    """One row: how many entities are in any of these sets."""
    united = sets.groupBy("bucket", "word").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(DISTINCT))


def entities_by_period(sets: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """Entities of each period, and how many of them the period before had:
    both counts less that of the united sets."""
    count = F.sum(F.bitmap_count("bits")).cast("long")
    own = sets.groupBy("period").agg(count.alias("n"))
    before = sets.withColumn("period", F.col("period") + 1)
    united = (sets.unionByName(before.join(own.select("period"), "period"))
              .groupBy("period", "bucket", "word").agg(F.bitmap_or_agg("bits").alias("bits"))
              .groupBy("period").agg(count.alias("all")))
    earlier = own.select((F.col("period") + 1).alias("period"), F.col("n").alias("m"))
    return own.join(united, "period").join(earlier, "period", "left").select(
        F.col("period").alias(spec.period), F.col("n").alias(BY_PERIOD),
        (F.col("n") + F.coalesce("m", F.lit(0)) - F.col("all")).alias(AGAIN))
