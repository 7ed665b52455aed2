"""The command line, run in-process against a small lake."""

from __future__ import annotations

import json

from conftest import SF_SMALL

from frostlake.__main__ import main
from frostlake.sinks.files import dump_json
from frostlake.sources.fixtures import telemetry
from frostlake.sources.lake import read_layer


def _run(capsys, *argv):
    assert main(list(argv)) == 0
    return json.loads(capsys.readouterr().out)


def test_cli_pipeline_and_serving(spark, tmp_dir, capsys):
    raw, lake = f"{tmp_dir}/raw", f"{tmp_dir}/lake"
    dump_json(telemetry(spark, SF_SMALL), raw)
    out = _run(capsys, "pipeline", raw, lake)
    assert {"batch", "staging", "silver", "gold", "total"} <= set(out["seconds"])
    tables = _run(capsys, "tables", lake)
    assert len(tables) == 18
    page = _run(capsys, "page", lake, "gold", "mart_daily_costs", "--page", "2", "--limit", "5")
    assert len(page["data"]) == 5 and page["pagination"]["has_next"]
    q = _run(capsys, "sql", lake, "SELECT COUNT(*) AS n FROM silver;")
    assert q["data"][0]["n"] == read_layer(spark, lake, "silver").count()
    dash = _run(capsys, "dashboard", lake)
    assert len(dash["metrics"]["daily_costs"]) == read_layer(spark, lake, "gold", "mart_daily_costs").select(
        "Date").distinct().count()
    out_csv = f"{tmp_dir}/export"
    _run(capsys, "export", lake, "gold", "mart_daily_costs", "--out", out_csv, "--limit", "7")
    back = spark.read.option("header", True).csv(out_csv)
    assert back.count() == 7 and set(back.columns) == {"Date", "Device_ID", "Daily_Cost_USD", "Daily_Power_kW"}
    assert not spark.sparkContext._jsc.sc().isStopped()  # an existing session is left running


def test_serving_latency_goes_to_the_run_log(spark, tmp_dir, capsys):
    from frostlake.plans import serving as S
    from frostlake.plans.medallion import run_pipeline
    from frostlake.sinks.files import RunLog

    lake = f"{tmp_dir}/lake"
    run_pipeline(spark, telemetry(spark, SF_SMALL), lake)
    log = RunLog()
    S.table_page_response(spark, lake, "silver", limit=3, log=log)
    S.query_response(spark, lake, "SELECT 1 AS x", log=log)
    S.dashboard_response(spark, lake, log=log)
    assert [e[2] for e in log.entries] == ["serve/page", "serve/query", "serve/dashboard"]
    assert log.entries[0][5] == 3


def test_cli_live_keeps_views_in_its_checkpoint(spark, tmp_dir, capsys):
    from frostlake.sources.fixtures import live
    from frostlake.streaming.live import read_live_views

    messages = live(spark, SF_SMALL)
    messages.write.option("ignoreNullFields", "false").json(f"{tmp_dir}/src")
    assert main(["live", "--files", f"{tmp_dir}/src", "--checkpoint", f"{tmp_dir}/ck", "--archive", f"{tmp_dir}/all", "--once"]) == 0
    views = read_live_views(spark, f"{tmp_dir}/ck")
    kept = messages.where("Entering_Chilled_Water_Temperature_Sensor IS NOT NULL").count()
    assert views["messages_received"].collect()[0][0] == kept and views["live_points"].count() == 20
    assert spark.read.json(f"{tmp_dir}/all").count() == messages.count()


def test_cli_drain_reads_until_quiet(spark, tmp_dir, capsys):
    from frostlake.sources.fixtures import live

    messages = live(spark, SF_SMALL)
    messages.write.option("ignoreNullFields", "false").json(f"{tmp_dir}/src")
    args = ("drain", "--files", f"{tmp_dir}/src", "--out", f"{tmp_dir}/out", "--checkpoint", f"{tmp_dir}/ck", "--quiet-polls", "1", "--pause", "0")
    n = messages.count()
    found = _run(capsys, *args)
    assert (found["rows"], found["runs"], found["quiet"]) == (n, 2, True)
    assert _run(capsys, *args)["rows"] == 0  # nothing new
    assert spark.read.json(f"{tmp_dir}/out").count() == n
