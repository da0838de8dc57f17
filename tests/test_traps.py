"""One test per semantic trap of the pipeline (T1-T26, A17)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from stratum.operators import marts, reporting
from stratum.operators.bronze import EmptySourceError, weighted_indicator
from stratum.operators.cleaning import clean, flag_missing, normalize_keys
from stratum.operators.reshape import NoGoalColumnsError, goals_long
from stratum.plans.ingest import ingest_table
from stratum.plans.silver import build_silver, prepare
from stratum.session import scratch_path
from stratum.sources.bronze import latest_snapshot, read_bronze, write_snapshot
from stratum.sources.layers import read_silver, write_silver
from stratum.sources.registry import SourceRegistry
from stratum.spec import DEFAULT_SPEC as S


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_t1_latest_snapshot_is_table_wide_max(spark):
    base = scratch_path(spark, "t1")
    a = spark.createDataFrame([("1", 2024), ("2", 2024)], "id_municipio string, ano int")
    b = spark.createDataFrame([("3", 2024)], "id_municipio string, ano int")
    write_snapshot(b, base, "t", "2024-01-02", "x")
    write_snapshot(a, base, "t", "2024-01-01", "x")
    assert rows(read_bronze(spark, base, "t"), "id_municipio") == [("3",)]
    assert len(read_bronze(spark, base, "t", latest=False).collect()) == 3


def test_t1_latest_snapshot_pruned_and_edge_cases(spark):
    base = scratch_path(spark, "t1b")
    a = spark.createDataFrame([("1", 2024)], "id_municipio string, ano int")
    write_snapshot(a, base, "t", "2024-01-01", "x")
    write_snapshot(a, base, "t", "2024-01-02", "x")
    files = read_bronze(spark, base, "t").inputFiles()
    assert files and all("/dt_ingestao=2024-01-02/" in f for f in files)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        latest_snapshot(spark.read.parquet(f"{base}/t")).explain("formatted")
    assert "PartitionFilters: [isnotnull(dt_ingestao#" in buf.getvalue()
    assert "(dt_ingestao#" in buf.getvalue() and "= Subquery subquery#" in buf.getvalue()
    empty = spark.createDataFrame([], "k string, dt_ingestao date")
    assert latest_snapshot(empty).count() == 0
    no_col = spark.createDataFrame([("a",)], "k string")
    assert latest_snapshot(no_col).count() == 1


def test_t2_dedup_before_normalisation(spark):
    df = spark.createDataFrame([("1", "sp"), ("1", " SP "), ("1", "sp")], "id_municipio string, sigla_uf string")
    out = prepare(df)
    assert rows(out) == [("1", "SP"), ("1", "SP")]


def test_t3_only_all_null_keys_dropped(spark):
    df = spark.createDataFrame([(None, 2024), (None, None), ("1", None)], "id_municipio string, ano int")
    assert {tuple(r) for r in clean(df, S.cleaning_keys).collect()} == {("1", None), (None, 2024)}


def test_t5_unparseable_metric_is_null_and_flagged(spark):
    df = spark.createDataFrame([("x",), ("12.5",), (None,)], "proficiencia_media string")
    out = rows(flag_missing(df, [S.score]))
    assert sorted(out, key=str) == sorted([(None, True), (12.5, False), (None, True)], key=str)


def test_t6_goals_keep_null_and_average_networks(spark):
    wide = spark.createDataFrame(
        [("1", 10.0, None), ("1", 20.0, None)],
        "id_municipio string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2025 double")
    out = rows(goals_long(wide, S.entity, S.goal_prefix, period=S.period, value=S.goal))
    assert out == [("1", 2024, 15.0), ("1", 2025, None)]


def test_t7_no_goal_columns_is_a_clear_error(spark):
    wide = spark.createDataFrame([("1",)], "id_municipio string")
    with pytest.raises(NoGoalColumnsError):
        goals_long(wide, S.entity, S.goal_prefix, period=S.period, value=S.goal)


def test_t8_period_column_in_goal_table_ignored(spark):
    wide = spark.createDataFrame([("1", 1999, 10.0)], "id_municipio string, ano int, meta_alfabetizacao_2024 double")
    out = rows(goals_long(wide, S.entity, S.goal_prefix, period=S.period, value=S.goal))
    assert out == [("1", 2024, 10.0)]


def _silver_inputs(spark):
    ind = spark.createDataFrame([("1", 2024, 500.0, 60.0), ("2", 2024, 400.0, 40.0), ("3", 2024, 300.0, None)],
                                "id_municipio string, ano int, proficiencia_media double,"
                                " percentual_alfabetizado double")
    dim = spark.createDataFrame([("1", "A", " sp", "Sao Paulo"), ("2", "B", "rj ", "Rio")],
                                "id_municipio string, nome string, sigla_uf string, nome_uf string")
    wide = spark.createDataFrame([("1", 50.0), ("3", 10.0)], "id_municipio string, meta_alfabetizacao_2024 double")
    return ind, dim, wide


def test_t9_left_joins_keep_unmatched(spark):
    ind, dim, wide = _silver_inputs(spark)
    out = {r.id_municipio: r for r in build_silver(ind, dim, wide, processed_at=False).collect()}
    assert out["3"].nome_municipio is None and out["3"].sigla_uf is None
    assert out["2"].meta_percentual is None and out["2"].sigla_uf == "RJ"
    assert out["1"].meta_percentual == 50.0


def test_t10_t11_partition_roundtrip_keeps_null_and_text_region(spark):
    ind, dim, wide = _silver_inputs(spark)
    dim = dim.withColumn("sigla_uf", F.when(F.col("id_municipio") == "1", F.lit("35")).otherwise(F.col("sigla_uf")))
    path = write_silver(build_silver(ind, dim, wide, processed_at=False), scratch_path(spark, "t10"))
    back = {r.id_municipio: r for r in read_silver(spark, path, processed_at=False).collect()}
    assert back["3"].sigla_uf is None
    assert back["1"].sigla_uf == "35"


def test_t12_null_gap_is_a_miss(spark):
    ind, dim, wide = _silver_inputs(spark)
    g = {r.id_municipio: r for r in marts.goal_vs_result(build_silver(ind, dim, wide, processed_at=False)).collect()}
    assert g["1"].atingiu_meta is True and g["1"].gap_para_meta == 10.0
    assert g["2"].atingiu_meta is False and g["2"].gap_para_meta is None
    assert g["3"].atingiu_meta is False


def test_t13_region_means_rounded_before_mean_of_means(spark):
    silver = spark.createDataFrame(
        [("1", "A", "X", "x", 2024, 1.0, 10.004), ("2", "B", "X", "x", 2024, 1.0, 10.0),
         ("3", "C", "Y", "y", 2024, 1.0, 20.0)],
        "id_municipio string, nome_municipio string, sigla_uf string, nome_uf string, ano int,"
        " proficiencia_media double, percentual_alfabetizado double")
    evo = marts.region_evolution(silver)
    assert rows(evo, "sigla_uf", marts.REGION_RATE, marts.REGION_COUNT) == [("X", 10.0, 2), ("Y", 20.0, 1)]
    nat = reporting.national_evolution(evo).collect()[0]
    assert nat[marts.REGION_RATE] == 15.0


def test_t15_weighted_share_null_flag_and_zero_weight(spark):
    micro = spark.createDataFrame(
        [("1", 2024, 10.0, "1", 5.0), ("1", 2024, 20.0, None, 5.0), ("2", 2024, 30.0, "1", 0.0)],
        "id string, ano int, score double, flag string, w double")
    out = {r.id: r for r in weighted_indicator(micro, ["id", "ano"], "score", "flag", "w",
                                               score_out="s", rate_out="r").collect()}
    assert out["1"].r == 50.0 and out["1"].s == 15.0
    assert out["2"].r is None


def test_t23_empty_source_aborts_without_writing(spark):
    base = scratch_path(spark, "t23")
    reg = SourceRegistry({"t": lambda s: s.createDataFrame([], "id_municipio string")})
    with pytest.raises(EmptySourceError):
        ingest_table(spark, reg, "t", base, "2024-01-01")
    assert spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base) \
        .filter(F.col("path").endswith(".parquet")).count() == 0


def test_t24_same_day_rerun_overwrites_that_day_only(spark):
    base = scratch_path(spark, "t24")
    df = spark.createDataFrame([("1",), ("2",)], "id_municipio string")
    write_snapshot(df, base, "t", "2024-01-01", "x")
    write_snapshot(df, base, "t", "2024-01-02", "x")
    write_snapshot(df, base, "t", "2024-01-02", "x")
    counts = rows(read_bronze(spark, base, "t", latest=False).groupBy("dt_ingestao").count(), "count")
    assert counts == [(2,), (2,)]


def test_t26_malformed_messages_quarantined_once(spark):
    from stratum.streaming.events import StreamConfig, drain, land

    base = scratch_path(spark, "t26")
    cfg = StreamConfig(landing=f"{base}/in", bronze=f"{base}/b", quarantine=f"{base}/q", checkpoint=f"{base}/c")
    lines = ['{"event_id": 1, "event_type": "view", "value": 1.5}', "not json",
             '{"event_id": broken', '{"event_id":"z"}']
    land(spark.createDataFrame([(x,) for x in lines], "value string"), cfg.landing, "b1")
    first = drain(spark, cfg)
    assert (first.bronze_rows, first.quarantine_rows) == (1, 3)
    again = drain(spark, cfg)
    assert (again.bronze_rows, again.quarantine_rows) == (0, 0)
    assert spark.read.parquet(cfg.bronze).count() == 1
    assert rows(spark.read.parquet(cfg.quarantine), "_raw") == sorted((x,) for x in lines[1:])


def test_a17_constant_histogram_lands_in_middle_bin(spark):
    ind = spark.createDataFrame([(2024, 5.0)] * 4 + [(2023, 1.0)], "ano int, v double")
    out = {r.bin: r for r in reporting.histogram(spark, ind, "v", "ano", 24).collect()}
    assert len(out) == 24 and out[13]["count"] == 4 and sum(r["count"] for r in out.values()) == 4
    assert out[1].bin_start == 4.5 and out[24].bin_end == 5.5


def test_histogram_last_bin_closed(spark):
    ind = spark.createDataFrame([(1, float(v)) for v in range(0, 25)], "ano int, v double")
    out = {r.bin: r["count"] for r in reporting.histogram(spark, ind, "v", "ano", 24).collect()}
    assert out[24] == 2 and sum(out.values()) == 25


def test_topk_ties_broken_by_id_and_label(spark):
    g = spark.createDataFrame(
        [("2", None, "SP", 2024, -5.0), ("1", "A", "SP", 2024, -5.0), ("3", "C", None, 2024, -1.0),
         ("4", "D", "RJ", 2024, None), ("5", "E", "RJ", 2023, -50.0)],
        "id_municipio string, nome_municipio string, sigla_uf string, ano int, gap_para_meta double")
    out = [(r.id_municipio, r.rotulo) for r in reporting.worst_gap_topk(g, k=2).collect()]
    assert out == [("1", "A (SP)"), ("2", "2 (SP)")]


def test_normalize_keys_types(spark):
    df = spark.createDataFrame([(35, " sp ", "2024"), (1, "rj", "x")], "id_municipio long, sigla_uf string, ano string")
    out = normalize_keys(df, entity=S.entity, region=S.region, period=S.period)
    assert dict(out.dtypes) == {"id_municipio": "string", "sigla_uf": "string", "ano": "int"}
    assert rows(out) == [("1", "RJ", None), ("35", "SP", 2024)]


def test_registry_select_and_union(spark):
    reg = SourceRegistry({"a": lambda s: s.createDataFrame([("1", 1)], "k string, v int"),
                          "b": lambda s: s.createDataFrame([(2, "2")], "v int, k string")})
    assert reg.select("all") == ["a", "b"] and reg.select("a") == ["a"]
    with pytest.raises(KeyError):
        reg.select("zzz")
    assert rows(reg.read_union(spark, ["a", "b"])) == [("1", 1), ("2", 2)]


def test_stream_continuous_run_resumes_from_checkpoint(spark):
    from stratum.streaming.events import StreamConfig, drain, land, run_for

    base = scratch_path(spark, "cont")
    cfg = StreamConfig(landing=f"{base}/in", bronze=f"{base}/b", quarantine=f"{base}/q",
                       checkpoint=f"{base}/c", trigger_interval="1 second")
    land(spark.createDataFrame([('{"event_id": 1}',), ('{"event_id": 2}',)], "value string"), cfg.landing, "b1")
    run_for(spark, cfg, 20)
    assert spark.read.parquet(cfg.bronze).count() == 2
    land(spark.createDataFrame([('{"event_id": 3}',)], "value string"), cfg.landing, "b2")
    assert drain(spark, cfg).bronze_rows == 1
    assert spark.read.parquet(cfg.bronze).count() == 3


def test_t19_orphan_check_sees_every_ingestion_date(spark):
    from stratum.plans.pipeline import Layout, run_checks
    from stratum.operators.quality import collect_results, ORPHANS

    layout = Layout(scratch_path(spark, "t19"))
    dim = "id_municipio string, nome string, sigla_uf string, nome_uf string"
    write_snapshot(spark.createDataFrame([("x", "X", "sp", "S"), ("y", "Y", "rj", "R")], dim),
                   layout.bronze, "municipio", "2024-01-01", "b")
    write_snapshot(spark.createDataFrame([("y", "Y", "rj", "R")], dim),
                   layout.bronze, "municipio", "2024-01-02", "b")
    ind, _, wide = _silver_inputs(spark)
    silver = build_silver(ind.filter(F.col("id_municipio").isin("1", "2")).replace({"1": "x", "2": "y"}),
                          read_bronze(spark, layout.bronze, "municipio"), wide)
    write_silver(silver, layout.silver)
    res = {r.name: r for r in collect_results(run_checks(spark, layout))}
    # "x" is only in the older snapshot: Silver has no name for it, yet it is no orphan
    assert res[ORPHANS].metrics["orfaos"] == 0
    names = {r.id_municipio: r.nome_municipio for r in read_silver(spark, layout.silver).collect()}
    assert names == {"x": None, "y": "Y"}


def test_scale_conf_sizes_partitions():
    from stratum.session import scale_conf

    big = scale_conf(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 122880  # 30 TB / 256 MB
    small = scale_conf(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24     # 3 waves of 8 cores


def test_stream_microbatch_replay_is_idempotent(spark):
    from stratum.streaming.events import RAW, StreamConfig, _batch_writer, parse, with_audit

    base = scratch_path(spark, "replay")
    cfg = StreamConfig(landing=f"{base}/in", bronze=f"{base}/b", quarantine=f"{base}/q", checkpoint=f"{base}/c")
    msgs = spark.createDataFrame([('{"event_id": 1}',), ('{"event_id": 2}',), ("oops",)], "value string")
    batch = with_audit(parse(msgs.select(F.col("value").alias(RAW)), cfg.schema), cfg)
    counts = {}
    write = _batch_writer(cfg, "w", counts)
    write(batch, 7)
    write(batch, 7)          # the same micro-batch delivered again after a failure
    write(batch, 8)          # a different micro-batch adds its own rows
    assert counts[7] == (2, 1) and counts[8] == (2, 1)
    assert spark.read.parquet(cfg.bronze).count() == 4
    assert spark.read.parquet(cfg.quarantine).count() == 2


def test_kpi_summary_from_marts_equals_silver_summary(spark):
    from stratum.plans import queries as Q

    sf = "/root/testdata/sf0.001"
    silver = Q.silver(spark, sf)
    a = reporting.kpi_summary(silver).collect()[0].asDict()
    b = reporting.kpi_summary_from_marts(marts.indicator_by_entity(silver, ordered=False),
                                         marts.goal_vs_result(silver)).collect()[0].asDict()
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k]) if isinstance(a[k], float) else a[k] == b[k]


def test_operators_follow_a_different_spec(spark):
    from stratum.operators import quality as dq
    from stratum.spec import IndicatorSpec

    spec = IndicatorSpec(entity="store", period="yr", region="zone", region_name="zone_name",
                         dim_name="label", entity_name="store_name", score_raw="score", flag_raw="ok",
                         weight_raw="w", score="avg_score", rate="ok_pct", goal_prefix="target_",
                         goal="target", gap="gap", hit="hit", null_flag_suffix="_missing",
                         natural_keys={"silver": ("store", "yr"), "municipio": ("store",)})
    micro = spark.createDataFrame([("s1", 2024, 10.0, "1", 1.0), ("s1", 2024, 20.0, "0", 1.0),
                                   ("s2", 2024, 30.0, "1", 2.0)], "store string, yr int, score double, ok string, w double")
    ind = weighted_indicator(micro, ["store", "yr"], "score", "ok", "w", score_out="avg_score", rate_out="ok_pct")
    dim = spark.createDataFrame([("s1", "One", " north ", "North")], "store string, label string, zone string, zone_name string")
    wide = spark.createDataFrame([("s1", 40.0), ("s2", 120.0)], "store string, target_2024 double")
    silver = build_silver(ind, dim, wide, spec, processed_at=False)
    assert silver.columns == ["store", "store_name", "zone", "zone_name", "yr", "avg_score", "ok_pct", "target",
                              "avg_score_missing", "ok_pct_missing"]
    g = {r.store: r for r in marts.goal_vs_result(silver, spec).collect()}
    assert g["s1"].hit is True and g["s1"].gap == 10.0 and g["s2"].hit is False and g["s1"].zone == "NORTH"
    checks = {r.name: r for r in dq.collect_results(dq.table_checks(
        silver, dim, keys=spec.keys_of("silver"), missing_cols=list(spec.metrics), range_col=spec.rate,
        orphan_keys_cols=spec.keys_of("municipio")))}
    assert checks[dq.ORPHANS].metrics[dq.M_ORPHANS] == 1 and checks[dq.DUPLICATES].passed
    evo = marts.region_evolution(silver, spec).collect()
    assert {(r.zone, r[marts.REGION_COUNT]) for r in evo} == {("NORTH", 1), (None, 1)}


def test_stream_crash_mid_batch_then_restart_is_exactly_once(spark, monkeypatch):
    from stratum.streaming import events as ev

    base = scratch_path(spark, "crash")
    cfg = ev.StreamConfig(landing=f"{base}/in", bronze=f"{base}/b", quarantine=f"{base}/q",
                          checkpoint=f"{base}/c")
    lines = ['{"event_id": 1}', '{"event_id": 2}', "broken"]
    ev.land(spark.createDataFrame([(x,) for x in lines], "value string"), cfg.landing, "b1")

    real = ev._write_idempotent
    calls = {"n": 0}

    def crash_on_quarantine(frame, path, cfg_, batch_id):
        calls["n"] += 1
        if path == cfg.quarantine and calls["n"] <= 2:   # Bronze written, then the "executor dies"
            raise RuntimeError("simulated loss")
        return real(frame, path, cfg_, batch_id)

    monkeypatch.setattr(ev, "_write_idempotent", crash_on_quarantine)
    with pytest.raises(Exception):
        ev.drain(spark, cfg)
    assert spark.read.parquet(cfg.bronze).count() == 2      # partial batch output is visible...
    result = ev.drain(spark, cfg)                           # ...restart replays the same micro-batch
    assert (result.bronze_rows, result.quarantine_rows) == (2, 1)
    assert spark.read.parquet(cfg.bronze).count() == 2      # replaced, not duplicated
    assert spark.read.parquet(cfg.quarantine).count() == 1
    assert ev.drain(spark, cfg).bronze_rows == 0            # nothing left to do


def test_t2_near_duplicate_dimension_rows_fan_out_and_are_caught(spark):
    from stratum.operators import quality as dq

    ind = spark.createDataFrame([("1", 2024, 500.0, 60.0)], "id_municipio string, ano int,"
                                " proficiencia_media double, percentual_alfabetizado double")
    dim = spark.createDataFrame([("1", "A", "sp", "S"), ("1", "A", " SP ", "S")],
                                "id_municipio string, nome string, sigla_uf string, nome_uf string")
    wide = spark.createDataFrame([("1", 50.0)], "id_municipio string, meta_alfabetizacao_2024 double")
    silver = build_silver(ind, dim, wide, processed_at=False)
    assert silver.count() == 2                      # both normalise to SP after dedup ran
    r = dq.collect_results(dq.duplicate_check(silver, ["id_municipio", "ano"]))[0]
    assert not r.passed and r.metrics[dq.M_DUPLICATES] == 1


def test_t15_zero_weight_rate_is_flagged_missing_in_silver(spark):
    micro = spark.createDataFrame([("1", 2024, 10.0, "1", 0.0), ("1", 2024, 20.0, "0", 0.0)],
                                  "id_municipio string, ano int, proficiencia double, alfabetizado string,"
                                  " peso_aluno double")
    ind = weighted_indicator(micro, ["id_municipio", "ano"], "proficiencia", "alfabetizado", "peso_aluno",
                             score_out=S.score, rate_out=S.rate)
    dim = spark.createDataFrame([("1", "A", "sp", "S")], "id_municipio string, nome string, sigla_uf string,"
                                " nome_uf string")
    wide = spark.createDataFrame([("1", 50.0)], "id_municipio string, meta_alfabetizacao_2024 double")
    row = build_silver(ind, dim, wide, processed_at=False).collect()[0]
    assert row.percentual_alfabetizado is None and row.percentual_alfabetizado_era_nulo is True
    assert row.proficiencia_media == 15.0 and row.proficiencia_media_era_nulo is False
