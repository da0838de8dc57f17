"""Gold refreshed by changed partitions: content, what is read, NULL keys."""

from pyspark.sql import functions as F

from stratum.plans import gold
from stratum.plans import testbed as tb
from stratum.plans.silver import build_silver
from stratum.session import scratch_path
from stratum.sources.layers import read_silver, write_silver
from stratum.spec import DEFAULT_SPEC as S

SF = "/root/testdata/sf0.001"


def make(spark):
    rows = build_silver(tb.indicator(spark, SF), tb.dimension(spark, SF), tb.goals_wide(spark, SF), S, processed_at=False)
    path = write_silver(rows, scratch_path(spark, "silver"))  # some regions are NULL here
    return read_silver(spark, path, processed_at=False), path


def content(marts):
    return {n: sorted(map(str, df.collect())) for n, df in marts.items()}


def full(spark, path):
    base = scratch_path(spark, "gold")
    gold.build_gold(spark, path, base, processed_at=False)
    return content(gold.read_marts(spark, base))


def test_refresh_equals_a_full_build(spark):
    rows, first = make(spark)
    base, path = scratch_path(spark, "gold"), scratch_path(spark, "silver")
    write_silver(rows, path)
    gold.refresh_gold(spark, path, base, processed_at=False)
    assert content(gold.read_marts(spark, base)) == full(spark, first)
    period = rows.agg(F.max(S.period)).first()[0]
    edits = [rows.withColumn(S.rate, F.when(F.col(S.region).isNull() & (F.col(S.period) == period), 1.0).otherwise(F.col(S.rate))),
             rows.where(F.col(S.period) != period),  # partitions gone
             rows.withColumn(S.goal, F.lit(None).cast("double")),  # all changed
             rows]
    for edit in edits:
        write_silver(edit, path)
        gold.refresh_gold(spark, path, base, processed_at=False)
        assert content(gold.read_marts(spark, base)) == full(spark, path)
    names = [r[S.entity_name] for r in gold.read_marts(spark, base)["gold_indicador_por_municipio"].collect()]
    assert len(names) == rows.count()


def test_only_changed_partitions_are_read(spark, monkeypatch):
    rows, path = make(spark)
    base, read = scratch_path(spark, "gold"), []
    gold.refresh_gold(spark, path, base, processed_at=False)
    inner = gold._in_partitions

    def spy(silver, changed, spec):
        out = inner(silver, changed, spec)
        read.append(({tuple(r) for r in changed}, out.inputFiles(), str(out._jdf.queryExecution().executedPlan())))
        return out

    monkeypatch.setattr(gold, "_in_partitions", spy)
    region, period = rows.where(F.col(S.region).isNotNull()).agg(F.min(S.region), F.min(S.period)).first()
    edited = F.when((F.col(S.region) == region) & (F.col(S.period) == period), -1.0)
    write_silver(rows.withColumn(S.score, F.coalesce(edited, S.score)), path)
    gold.refresh_gold(spark, path, base, processed_at=False)
    changed, files, plan = read[0]
    assert changed <= {(period, region)}
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    write_silver(rows.withColumn(S.score, F.coalesce(edited, S.score)), path)  # the same rows, another version
    gold.refresh_gold(spark, path, base, processed_at=False)
    assert read[1][0] == set()
