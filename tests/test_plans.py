"""Plan-shape tests: the properties the design relies on at scale, checked on
the physical plan so a regression shows up here and not on a cluster."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from stratum.operators import quality as dq
from stratum.operators import reporting as rp
from stratum.operators.bronze import weighted_indicator
from stratum.operators.cleaning import dedup_rows
from stratum.operators.reshape import goals_long
from stratum.plans import testbed as tb
from stratum.plans.silver import prepare
from stratum.spec import DEFAULT_SPEC as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


def test_indicator_aggregates_before_the_shuffle(spark):
    p = plan(tb.indicator(spark, SF))
    assert tree(tb.indicator(spark, SF)).count("Exchange") == 1
    assert "partial_avg" in p and "partial_sum" in p


def test_dedup_reuses_the_aggregate_partitioning(spark):
    deduped = dedup_rows(tb.indicator(spark, SF))
    assert tree(deduped).count("Exchange") == 1


def test_goals_unpivot_scans_once(spark):
    long = goals_long(prepare(tb.goals_wide(spark, SF)), S.entity, S.goal_prefix, period=S.period, value=S.goal)
    t = tree(long)
    assert t.count("Scan parquet") == 1 and "Expand" in t and "Union" not in t


def test_duplicate_check_is_partial_aggregate(spark):
    p = plan(dq.duplicate_check(tb.table(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "partial_count" in p


def test_orphan_check_distinct_keys_before_anti_join(spark):
    child = tb.table(spark, SF, "lineitem").select(F.col("l_suppkey").alias("k"))
    parent = tb.table(spark, SF, "supplier").select(F.col("s_suppkey").alias("k"))
    for df in (dq.orphan_keys(child, parent, ["k"]),
               dq.orphan_keys(child, parent.hint("shuffle_merge"), ["k"])):
        t = tree(df)
        join = re.search(r"(SortMergeJoin|BroadcastHashJoin) LeftOuter", t).start()
        # below the join (later in the tree text) each side is aggregated before its exchange
        below = t[join:]
        assert below.count("HashAggregate") >= 4
        assert "LeftAnti" not in t


def test_topk_without_global_sort(spark):
    g = spark.createDataFrame([("1", "a", "X", 2024, -1.0)],
                              "id_municipio string, nome_municipio string, sigla_uf string, ano int,"
                              " gap_para_meta double")
    t = tree(rp.worst_gap_topk(g, k=10))
    assert "TakeOrderedAndProject" in t and not re.search(r"\bSort \(", t)


def test_scans_read_only_used_columns(spark):
    p = plan(tb.indicator(spark, SF))
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", p).group(1)
    assert "l_orderkey" not in schema and "l_tax" not in schema and "l_suppkey" in schema


def test_hot_entity_with_a_third_of_rows(spark):
    # one entity holds a third of the rows; results stay exact and whole
    rows = [("hot", 2024, 10.0, "1", 1.0)] * 300 + [(f"e{i}", 2024, 20.0, "0", 2.0) for i in range(600)]
    micro = spark.createDataFrame(rows, "id string, ano int, score double, flag string, w double").repartition(8)
    out = {r.id: r for r in weighted_indicator(micro, ["id", "ano"], "score", "flag", "w",
                                               score_out="s", rate_out="r").collect()}
    assert len(out) == 601 and out["hot"].r == 100.0 and out["hot"].s == 10.0 and out["e5"].r == 0.0
    dup = dq.collect_results(dq.duplicate_check(micro, ["id", "ano"]))[0]
    assert dup.metrics[dq.M_DUPLICATES] == 299


def test_latest_period_prunes_stored_silver(spark):
    from stratum.plans import queries as Q
    from stratum.session import scratch_path
    from stratum.sources.layers import read_silver, write_silver

    path = write_silver(Q.silver(spark, SF, processed_at=True), scratch_path(spark, "prune"))
    p = plan(rp.at_latest(read_silver(spark, path), S.period))
    assert re.search(r"PartitionFilters: \[isnotnull\(ano#\d+\), \(ano#\d+ = Subquery subquery#", p)


def test_results_do_not_depend_on_the_physical_strategy(spark):
    """At scale the dimension is not broadcast and AQE re-plans; the results
    must be the same whichever strategy runs."""
    from stratum.plans import queries as Q

    def run():
        silver = sorted(map(tuple, Q.silver(spark, SF).collect()), key=repr)
        checks = sorted(map(tuple, Q.dq_report(spark, SF).collect()), key=repr)
        return silver, checks

    baseline = run()
    confs = [{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
             {"spark.sql.adaptive.enabled": "false"},
             {"spark.sql.shuffle.partitions": "3"}]
    for conf in confs:
        old = {k: spark.conf.get(k, None) for k in conf}
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            assert run() == baseline, conf
        finally:
            for k, v in old.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def test_silver_join_order_saves_a_fact_shuffle(spark):
    """With a dimension too large to broadcast, goals-first costs 10 hash
    exchanges; the dimension-first order would re-shuffle the fact (11)."""
    from stratum.plans import queries as Q

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(Q.silver(spark, SF)).count("Exchange (") == 10
        assert tree(Q.silver(spark, SF)).count("SortMergeJoin LeftOuter") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
