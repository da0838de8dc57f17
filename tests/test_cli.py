"""The command line runs the stages in order on files written from the test
tables (sources given as paths, like a deployment)."""

import contextlib
import io
import json

from stratum.__main__ import main
from stratum.plans import testbed as tb
from stratum.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_cli_stages(spark, tmp_path):
    raw = scratch_path(spark, "cli-raw")
    sources = {}
    for key, df in (("indicador", tb.indicator(spark, SF)),
                    ("municipio", tb.dimension(spark, SF, registered_only=False)),
                    ("meta_municipio", tb.goals_wide(spark, SF))):
        df.write.parquet(f"{raw}/{key}")
        sources[key] = {"path": f"{raw}/{key}", "format": "parquet"}
    cfg = tmp_path / "sources.json"
    cfg.write_text(json.dumps(sources))
    base = scratch_path(spark, "cli")
    assert main(["run", "--base", base, "--sources", str(cfg), "--date", "2024-01-01"], spark=spark) == 0
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(["report", "--base", base], spark=spark) == 0
    reports = [json.loads(line) for line in out.getvalue().splitlines() if line.startswith("{")]
    kinds = {r["report"] for r in reports}
    assert kinds == {"kpis", "regions_latest", "national_evolution", "distribution", "worst_gaps"}
    assert sum(1 for r in reports if r["report"] == "distribution") == 24
    # a dimension missing one entity leaves an orphan: the gate stops the run
    sources["municipio"]["path"] = f"{raw}/municipio_partial"
    dim = tb.dimension(spark, SF, registered_only=False)
    dim.filter(dim.id_municipio != "0").write.parquet(sources["municipio"]["path"])
    cfg.write_text(json.dumps(sources))
    base2 = scratch_path(spark, "cli2")
    with contextlib.redirect_stdout(io.StringIO()):
        code = main(["run", "--base", base2, "--sources", str(cfg), "--date", "2024-01-01"], spark=spark)
    assert code == 2
    # T22: the gate sits after the Silver write -- Silver is there, Gold is not
    from stratum.plans.pipeline import Layout
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base2) \
        .select("path").collect()
    paths = [r.path for r in files if r.path.endswith(".parquet")]
    layout = Layout(base2)
    assert any(layout.silver in p for p in paths)
    assert not any(layout.gold in p for p in paths)


def test_cli_individual_stages(spark, tmp_path):
    from stratum.streaming.events import events_as_json, land

    raw = scratch_path(spark, "cli-raw3")
    sources = {}
    for key, df in (("indicador", tb.indicator(spark, SF)),
                    ("municipio", tb.dimension(spark, SF, registered_only=False)),
                    ("meta_municipio", tb.goals_wide(spark, SF))):
        df.write.parquet(f"{raw}/{key}")
        sources[key] = {"path": f"{raw}/{key}"}
    cfg = tmp_path / "sources.json"
    cfg.write_text(json.dumps(sources))
    base = scratch_path(spark, "cli3")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(["ingest", "--base", base, "--sources", str(cfg), "--date", "2024-01-01",
                     "--table", "indicador"], spark=spark) == 0
        assert main(["ingest", "--base", base, "--sources", str(cfg), "--date", "2024-01-01",
                     "--table", "all"], spark=spark) == 0
        assert main(["silver", "--base", base], spark=spark) == 0
        assert main(["quality", "--base", base], spark=spark) == 0
        assert main(["gold", "--base", base], spark=spark) == 0
        landing = scratch_path(spark, "cli3-in")
        land(events_as_json(tb.table(spark, SF, "events")), landing, "b1")
        assert main(["stream", "--base", base, "--landing", landing], spark=spark) == 0
    metrics = [json.loads(line) for line in out.getvalue().splitlines() if line.startswith("{")]
    jobs = [m.get("job") for m in metrics if "job" in m]
    assert jobs.count("ingest_batch_indicador") == 2 and "transform_silver" in jobs
    assert sum(1 for j in jobs if j and j.startswith("build_gold")) == 3
    drained = [m for m in metrics if "bronze_rows" in m][0]
    assert drained["bronze_rows"] == tb.table(spark, SF, "events").count()
