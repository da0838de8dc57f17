"""Gold build: all marts from one Silver table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.marts import by_name, by_region, goal_vs_result, indicator_by_entity, region_evolution
from stratum.sources.files import names
from stratum.sources.layers import read_gold, read_silver, write_gold
from stratum.sources.metrics import RunMetric, append_metrics, observed_write
from stratum.sources.versions import current, is_published, publish
from stratum.spec import DEFAULT_SPEC, IndicatorSpec

Mart = Callable[[DataFrame, IndicatorSpec], DataFrame]

# Names of the three marts.
MARTS: dict[str, Mart] = {
    "gold_indicador_por_municipio": indicator_by_entity,
    "gold_meta_vs_resultado": goal_vs_result,
    "gold_evolucao_temporal_uf": region_evolution,
}

#: The order of a mart's rows, where it has one.
ORDER: dict[str, Mart] = {
    "gold_indicador_por_municipio": by_name,
    "gold_meta_vs_resultado": lambda mart, spec: mart,
    "gold_evolucao_temporal_uf": by_region,
}


def mart_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def build_gold(spark: SparkSession, silver_path: str, gold_base: str,
               spec: IndicatorSpec = DEFAULT_SPEC, *, processed_at: bool = True,
               metrics: str | None = None, marts: dict[str, Mart] = MARTS) -> list[RunMetric]:
    """Write every mart of a new version of ``gold_base``; each is counted
    during its own write, and with ``metrics`` its record stored there as it
    ends.  The version is published when all are written: marts are always read
    as one run left them.

    The marts are independent: their jobs are submitted side by side.

    Silver is a columnar table, so each mart scans only the columns it uses;
    caching the whole table for three narrow reads would cost more than it
    saves.
    """
    silver = read_silver(spark, silver_path, spec, processed_at=processed_at)

    return publish(spark, gold_base, lambda folder: _write_marts(spark, silver, folder, spec, marts, metrics))


def _write_marts(spark: SparkSession, silver: DataFrame, folder: str, spec: IndicatorSpec, marts: dict[str, Mart],
                 metrics: str | None, taken: dict[str, DataFrame] | None = None) -> list[RunMetric]:
    """``taken``: rows of each mart that need not be built."""
    def write(name: str) -> RunMetric:
        mart = marts[name](silver, spec)
        if taken:
            mart = ORDER[name](mart.unionByName(taken[name]), spec)
        metric = observed_write(mart, lambda d: write_gold(d, mart_path(folder, name)), job=f"build_{name}", layer="gold")
        if metrics:
            append_metrics(spark, [metric], metrics)
        return metric

    with ThreadPoolExecutor(max_workers=len(marts)) as pool:
        return list(pool.map(write, marts))


#: In a version of Gold, the digests of the Silver partitions it was built from.
DIGESTS = "silver_digests"


def partition_digests(silver: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """(period, region, rows, digest) of each Silver partition: equal for equal
    rows in any order, whenever they were processed."""
    s = spec
    columns = sorted(c for c in silver.columns if c != s.processed_at)
    # NULLs told apart from values and from each other's places
    row = F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    return silver.groupBy(s.period, s.region).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("digest"))


def changed_partitions(before: DataFrame, now: DataFrame, spec: IndicatorSpec = DEFAULT_SPEC) -> DataFrame:
    """(period, region) of partitions that are new, gone or different."""
    s = spec
    same = (F.col(f"b.{s.period}").eqNullSafe(F.col(f"n.{s.period}"))
            & F.col(f"b.{s.region}").eqNullSafe(F.col(f"n.{s.region}")))
    both = before.alias("b").join(now.alias("n"), same, "full")
    differs = ~(F.col("b.rows").eqNullSafe(F.col("n.rows")) & F.col("b.digest").eqNullSafe(F.col("n.digest")))
    is_now = F.col("n.rows").isNotNull()
    return both.where(differs).select(*[F.when(is_now, F.col(f"n.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
                                        for c in (s.period, s.region)])


def _outside(mart: DataFrame, keys: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Rows of a mart in none of these (_period, _region) partitions."""
    s = spec
    same = mart[s.period].eqNullSafe(keys["_period"]) & mart[s.region].eqNullSafe(keys["_region"])
    return mart.join(keys, same, "left_anti")


def refresh_gold(spark: SparkSession, silver_path: str, gold_base: str, spec: IndicatorSpec = DEFAULT_SPEC, *,
                 processed_at: bool = True, metrics: str | None = None) -> list[RunMetric]:
    """A new version of Gold in which only what changed is built anew.

    Every row of a mart belongs to one (period, region) partition of Silver.
    Rows of partitions whose digest is the one that the current Gold was built
    from are taken from there; the others are built from these partitions of
    Silver alone, named in a partition filter.  Without a current Gold, or one
    without digests, all of it is built.  The digests are one aggregate over
    Silver, which needs no sort and no join.
    """
    s = spec
    silver = read_silver(spark, silver_path, spec, processed_at=processed_at)
    base = current(spark, gold_base) if is_published(spark, gold_base) else None
    known = base is not None and DIGESTS in names(spark, base)

    def write_all(folder: str) -> list[RunMetric]:
        partition_digests(silver, spec).coalesce(1).write.parquet(f"{folder}/{DIGESTS}")
        source, taken = silver, {}
        if known:
            now, before = (spark.read.parquet(f"{f}/{DIGESTS}") for f in (folder, base))
            changed = changed_partitions(before, now, spec).collect()  # a row for each partition at most
            kind = silver.schema[s.period].dataType.simpleString()
            keys = spark.createDataFrame([tuple(r) for r in changed], f"_period {kind}, _region string")
            source = _in_partitions(silver, changed, spec)
            for name in MARTS:
                taken[name] = _outside(read_gold(spark, mart_path(base, name)), keys, spec)
        return _write_marts(spark, source, folder, spec, MARTS, metrics, taken)

    return publish(spark, gold_base, write_all)


def _in_partitions(silver: DataFrame, changed: list, spec: IndicatorSpec) -> DataFrame:
    """Rows of these partitions, by a filter on partition columns."""
    s = spec
    wanted = F.lit(False)
    by_period: dict = {}
    for r in changed:
        by_period.setdefault(r[s.period], []).append(r[s.region])
    for period, regions in by_period.items():
        some = [x for x in regions if x is not None]
        region = F.col(s.region).isin(some) if some else F.lit(False)
        if None in regions:
            region = region | F.col(s.region).isNull()
        wanted = wanted | (F.col(s.period).eqNullSafe(F.lit(period)) & region)
    return silver.where(wanted)


def written_marts(spark: SparkSession, gold_base: str) -> set[str]:
    """Names of the marts that can be read: all once a version is published."""
    return set(MARTS) if is_published(spark, gold_base) else set()


def read_marts(spark: SparkSession, gold_base: str) -> dict[str, DataFrame]:
    """The marts of the current version, all of one run."""
    folder = current(spark, gold_base)
    return {name: read_gold(spark, mart_path(folder, name)) for name in MARTS}
