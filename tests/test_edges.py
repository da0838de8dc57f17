"""Edge inputs of the layers: other vocabularies, odd names, NaN, overwrite
modes, event shapes, missing shared folder."""

import contextlib
import io
import json
import types
import uuid

import pytest
from pyspark.sql import functions as F

from stratum import session
from stratum.__main__ import main
from stratum.operators import quality as dq
from stratum.operators import reporting as rp
from stratum.operators.cleaning import normalize_keys
from stratum.plans import pipeline as pl
from stratum.plans import testbed as tb
from stratum.plans.gold import read_marts
from stratum.session import scratch_path
from stratum.sources.layers import write_partitioned
from stratum.sources.registry import SourceRegistry
from stratum.spec import IndicatorSpec
from stratum.streaming.events import RAW, StreamConfig, drain, field, fields_found, land

SF = "/root/testdata/sf0.001"


def lines(fn, *args, **kw):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        code = fn(*args, **kw)
    return code, [json.loads(x) for x in out.getvalue().splitlines() if x.startswith("{")]


def test_whole_pipeline_under_other_names(spark):
    spec = IndicatorSpec(entity="store", period="yr", region="zone", region_name="zone_name", dim_name="label",
                         entity_name="store_name", score="avg_score", rate="ok_%", goal_prefix="target_",
                         goal="target", gap="gap", hit="hit", null_flag_suffix="_missing")
    reg = SourceRegistry({
        "indicador": lambda s: s.createDataFrame([("1", "2024.0", 3.0, 50.0), ("2", "2024", 4.0, 60.0)],
                                                 "store string, yr string, avg_score double, `ok_%` double"),
        "municipio": lambda s: s.createDataFrame([("1", "A", "x", "X"), ("2", "B", "y", "Y")],
                                                 "store string, label string, zone string, zone_name string"),
        "meta_municipio": lambda s: s.createDataFrame([("1", 40.0), ("2", 70.0)], "store string, target_2024 double")})
    res = pl.run_pipeline(spark, reg, scratch_path(spark, "named"), "2024-01-01", spec, report=lambda _m: None)
    assert res.gate_passed and res.gold_written
    mart = read_marts(spark, res.layout.gold)["gold_meta_vs_resultado"]
    assert sorted((r.store, r.yr, r.gap, r.hit) for r in mart.collect()) == [("1", 2024, 10.0, True), ("2", 2024, -10.0, False)]


def test_percent_signs_in_names(spark):
    df = spark.createDataFrame([(1, 120.0), (1, 5.0)], "`k_%d` int, `taxa_%` double")
    parent = spark.createDataFrame([(2,)], "`k_%d` int")
    got = {r.name: r for r in dq.collect_results(dq.table_checks(
        df, parent, keys=["k_%d"], missing_cols=["taxa_%"], range_col="taxa_%", orphan_keys_cols=["k_%d"]))}
    assert got["consistencia_taxa_%"].metrics["invalidos"] == 1 and "taxa_%" in got["consistencia_taxa_%"].details
    assert got[dq.DUPLICATES].details == "1 duplicate rows on ['k_%d'] (of 2)"
    assert got[dq.ORPHANS].details == "1 keys ['k_%d'] without a parent row"


def test_periods_as_text(spark):
    raw = spark.createDataFrame([(x,) for x in ("2024", "2024.0", " 2024 ", "2024.9", "x", None, "1e3", "99999999999")], "p string")
    assert [r.p for r in normalize_keys(raw, period="p").collect()] == [2024, 2024, 2024, 2024, None, None, 1000, None]


def test_nan_is_dropped_from_reports(spark):
    nan = float("nan")
    ind = spark.createDataFrame([("a", 1, nan), ("b", 1, 50.0), ("c", 1, 60.00004), ("d", 1, None)], "e string, p int, v double")
    bins = rp.histogram(spark, ind, "v", "p", bins=2).orderBy("bin").collect()
    assert [b["count"] for b in bins] == [1, 1] and bins[0].bin_start == 50.0 and bins[0].mean == pytest.approx(55.00002, abs=1e-12)
    goals = spark.createDataFrame([("a", "A", "r", 1, nan), ("b", "B", "r", 1, -2.0), ("c", "C", "r", 1, None)],
                                  "id_municipio string, nome_municipio string, sigla_uf string, ano int, gap_para_meta double")
    assert [r.id_municipio for r in rp.worst_gap_topk(goals).collect()] == ["b"]


@pytest.mark.parametrize("values, mean", [([10.00004, 20.00004], 15.00004), ([1e12, 2e12], 1.5e12), ([1 / 3], 1 / 3),
                                          ([float("inf"), 1.0], float("inf")), ([None], None), ([float("nan")], None)])
def test_mean_keeps_decimals(spark, values, mean):
    from stratum.functions import exact_mean
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_mean("v")).first()[0]
    assert got == mean or got == pytest.approx(mean, rel=1e-15)


def test_full_overwrite_under_a_dynamic_session(spark):
    path = scratch_path(spark, "overwrite")
    old = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, p int")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_partitioned(old, path, ["p"])
        write_partitioned(old.where("p = 2024"), path, ["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.p for r in spark.read.parquet(path).collect()] == [2024]


def test_metrics_of_finished_jobs_survive_a_failure(spark, monkeypatch):
    def fail(*a, **k):
        raise OSError("disk")

    monkeypatch.setattr(pl, "build_silver", fail)
    base = scratch_path(spark, "failing")
    with pytest.raises(OSError, match="disk"):
        pl.run_pipeline(spark, tb.registry(SF, registered_only=False), base, "2024-01-01")
    jobs = {r.job for r in spark.read.parquet(pl.Layout(base).metrics).collect()}
    assert jobs == {"ingest_batch_indicador", "ingest_batch_municipio", "ingest_batch_meta_municipio"}


def test_cli_streams_events_of_any_shape(spark):
    """Events with text ids and fields the test table doesn't have."""
    base, landing = scratch_path(spark, "shape"), scratch_path(spark, "shape-in")
    events = [{"event_id": str(uuid.UUID(int=i)), "event_type": "nova", "id_municipio": "2304400", "ano": 2026,
               "percentual": 41.5, "event_timestamp": "2026-01-01T00:00:00+00:00", "extra": {"a": [1]}} for i in range(5)]
    land(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"), landing, "b1")
    code, out = lines(main, ["stream", "--base", base, "--landing", landing], spark=spark)
    assert code == 0 and out[-1] == {"rows_in": 5, "bronze_rows": 5, "quarantine_rows": 0}
    stored = spark.read.parquet(f"{base}/bronze/eventos")
    rows = stored.collect()
    assert fields_found(stored) == ("OBJECT<ano: BIGINT, event_id: STRING, event_timestamp: STRING, event_type: STRING, "
                                    "extra: OBJECT<a: ARRAY<BIGINT>>, id_municipio: STRING, percentual: DECIMAL(3,1)>")
    typed = stored.select(field("$.event_id", "string"), field("$.ano", "int"), field("$.extra.a[0]", "int"),
                          field("$.percentual", "double"), field("$.none", "int"), field("$.event_type", "int"))
    assert sorted(map(tuple, typed.collect())) == [(e["event_id"], 2026, 1, 41.5, None, None) for e in events]
    assert sorted(r._raw for r in rows) == sorted(json.dumps(e) for e in events)
    with_schema = scratch_path(spark, "shape2")
    code, out = lines(main, ["stream", "--base", with_schema, "--landing", landing, "--schema",
                             "event_id string, ano int, percentual double"], spark=spark)
    assert out[-1]["quarantine_rows"] == 0
    assert spark.read.parquet(f"{with_schema}/bronze/eventos").agg(F.sum("ano")).first()[0] == 5 * 2026
    metrics = spark.read.parquet(f"{with_schema}/metrics").collect()
    assert [(m.job, m.rows_processed) for m in metrics] == [("ingest_streaming", 5)]


def test_wrong_types_and_null_values_are_quarantined(spark):
    from stratum.streaming.events import EVENT_SCHEMA, parse
    raw = ['{"event_id": 1}', '{"event_id": "x"}', None, "", " ", "5", "null", "{}", '{"event_id": 1} {"event_id": 2}', "{'event_id': 1}"]
    msgs = spark.createDataFrame([(r,) for r in raw], f"{RAW} string")
    assert [r._corrupt_record for r in parse(msgs, EVENT_SCHEMA).collect()] == [False, True, True, True, True, True, True, False, True, True]
    assert [r._corrupt_record for r in parse(msgs, None).collect()] == [False, False, True, True, True, True, True, False, True, True]


def test_a_rerun_under_the_same_checkpoint_keeps_its_id(spark):
    base = scratch_path(spark, "writer")
    cfg = StreamConfig(landing=f"{base}/in", bronze=f"{base}/b", quarantine=f"{base}/q", checkpoint=f"{base}/c")
    for i in range(2):
        land(spark.createDataFrame([(f'{{"event_id": {i}}}',)], "value string"), cfg.landing, f"b{i}")
        drain(spark, cfg)
    names = sorted(r._lote for r in spark.read.parquet(cfg.bronze).collect())
    assert [n.rpartition("-")[2] for n in names] == ["0", "1"] and len({n.rpartition("-")[0] for n in names}) == 1


def test_cli_from_microdata(spark, tmp_path):
    raw = scratch_path(spark, "micro-raw")
    tb.microdata(spark, SF).write.parquet(f"{raw}/m")
    tb.dimension(spark, SF, registered_only=False).write.parquet(f"{raw}/d")
    tb.goals_wide(spark, SF).write.parquet(f"{raw}/g")
    cfg = tmp_path / "sources.json"
    cfg.write_text(json.dumps({"indicador": {"path": f"{raw}/m", "microdata": True}, "municipio": {"path": f"{raw}/d"},
                               "meta_municipio": {"path": f"{raw}/g"}}))
    base = scratch_path(spark, "micro")
    code, out = lines(main, ["run", "--base", base, "--sources", str(cfg), "--date", "2024-01-01"], spark=spark)
    assert code == 0
    assert {m["job"]: m["rows_processed"] for m in out}["ingest_batch_indicador"] == tb.indicator(spark, SF).count()


def test_a_cluster_without_a_shared_folder_raises(monkeypatch):
    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(session.NoSharedFolderError):
        session.shared_dir(types.SimpleNamespace(sparkContext=sc))
    assert session._local_folder("local[4]")


def test_scratch_is_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session._scratch[-1] == path
    keep = session._scratch[:-1]
    session._scratch[:] = [path]
    session.remove_scratch()
    session._scratch[:] = keep
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
