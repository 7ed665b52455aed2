"""Sinks: layer schema guard, exports, raw landing, manifest, run log."""

from __future__ import annotations

import glob
import os
import re

import pytest
from conftest import raw_df, raw_row

from frostlake.sinks import files as K
from frostlake.sources.lake import read_raw_json
from frostlake.sources.versions import VERSION_IN_PATH, current_path


def test_write_layer_guards_schema(spark, tmp_dir):
    path = f"{tmp_dir}/layer"
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    assert K.write_layer(a, path) == 1
    assert K.write_layer(spark.createDataFrame([(2, "y"), (3, "z")], "id int, s string"), path) == 2
    b = spark.createDataFrame([(1, 2.0)], "id int, s double")
    with pytest.raises(K.SchemaMismatch):
        K.write_layer(b, path)
    K.write_layer(b, path, overwrite_schema=True)
    assert spark.read.parquet(current_path(spark, path)).dtypes == [("id", "int"), ("s", "double")]


def test_write_layer_stops_if_the_old_layer_is_unreadable(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "id int")
    os.makedirs(f"{tmp_dir}/empty")
    assert K.write_layer(df, f"{tmp_dir}/empty") == 1
    os.makedirs(f"{tmp_dir}/broken")
    with open(f"{tmp_dir}/broken/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        K.write_layer(df, f"{tmp_dir}/broken")
    assert os.path.exists(f"{tmp_dir}/broken/part-0.parquet")


def test_export_csv_quotes_and_nulls(spark, tmp_dir):
    df = spark.createDataFrame([("a\"b", None, 1.5), ("plain", "x,y", None)], "s string, t string, v double")
    out = f"{tmp_dir}/csv"
    K.export_csv(df, out, single_file=True)
    (part,) = glob.glob(f"{out}/part-*.csv")
    text = open(part).read().splitlines()
    assert text[0] == '"s","t","v"'
    assert '"a""b","null","1.5"' in text
    back = spark.read.schema(df.schema).option("header", True).option("nullValue", "null").option("escape", '"').csv(out)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_export_json_keeps_nulls(spark, tmp_dir):
    df = spark.createDataFrame([("a", None)], "s string, v double")
    out = f"{tmp_dir}/json"
    K.export_json(df, out, single_file=True)
    (part,) = glob.glob(f"{out}/part-*.json")
    assert open(part).read().strip() == '{"s":"a","v":null}'


def test_land_raw_keeps_lines(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    lines = ['{"Device_ID": "CHILLER_01", "timestamp": "1"}', "not json", '{"Device_ID": "CHILLER_02"}']
    with open(f"{src}/in.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    K.land_raw(spark, src, f"{tmp_dir}/raw")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/raw").collect()) == sorted(lines)
    df = read_raw_json(spark, f"{tmp_dir}/raw", keep_corrupt=True)
    assert sum(1 for r in df.collect() if r._corrupt_record is not None) == 1
    assert len(df.columns) == 41


def test_keyed_json_keeps_nulls(spark):
    df = spark.createDataFrame([("CHILLER_01", None, 1.0)], "Device_ID string, Active_Fault_Code string, x double")
    row = K.encode_keyed_json(df).collect()[0]
    assert row.key == "CHILLER_01"
    assert row.value == '{"Device_ID":"CHILLER_01","Active_Fault_Code":null,"x":1.0}'


def test_manifest_relative_paths(spark, tmp_dir):
    K.write_layer(raw_df(spark, [raw_row()]), f"{tmp_dir}/lake/silver")
    rows = K.lake_manifest(spark, f"{tmp_dir}/lake").collect()
    assert rows and all(re.match(f"silver{VERSION_IN_PATH}part-", r.relative_path) for r in rows)
    assert all(r.length > 0 for r in rows)


def test_run_log(spark):
    import time

    log = K.RunLog()
    t = time.time()
    log.record("staging", t, 10)
    log.close()
    df = log.to_df(spark)
    assert [r.stage for r in df.orderBy("seq").collect()] == ["staging", "total"]


def test_run_log_timed_and_shuffle_sizing(spark, tmp_dir):
    from frostlake.session import shuffle_partitions_for

    log = K.RunLog()
    with log.timed("request"):
        pass
    assert log.entries[0][2] == "request"
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_partitions_for(spark, f"{tmp_dir}/missing") == default
    os.makedirs(f"{tmp_dir}/big")
    with open(f"{tmp_dir}/big/f.bin", "wb") as f:
        f.truncate(10 * 1024 * 1024)  # sparse 10 MB
    assert shuffle_partitions_for(spark, f"{tmp_dir}/big", bytes_per_partition=1024 * 1024, expansion=2.0) == max(
        default, 20
    )


def test_pipeline_rerun_with_partitioned_silver(spark, tmp_dir):
    from conftest import SF_SMALL

    from frostlake.plans.medallion import PipelineConfig, run_pipeline
    from frostlake.sources.fixtures import telemetry

    cfg = PipelineConfig(silver_partition_by=("Date",))
    raw = telemetry(spark, SF_SMALL)
    run_pipeline(spark, raw, f"{tmp_dir}/lake", cfg)
    log = run_pipeline(spark, raw, f"{tmp_dir}/lake", cfg)  # same schema: allowed
    assert log.as_dict()["silver"] >= 0
    assert os.path.isdir(glob.glob(f"{tmp_dir}/lake/silver/v*/Date=*")[0])


def test_conform_raw(spark):
    from frostlake.schema import RAW_FIELDS
    from frostlake.sources.lake import conform_raw

    df = spark.createDataFrame([(1704067200000, "CHILLER_01", 500, "x")], "timestamp long, Device_ID string, "
                                                                          "CO2_Level_PPM int, extra string")
    out = conform_raw(df)
    assert tuple(out.columns) == RAW_FIELDS and set(out.dtypes[i][1] for i in range(40)) == {"string"}
    r = out.collect()[0]
    assert r.timestamp == "1704067200000" and r.CO2_Level_PPM == "500" and r.Oil_Temperature_Sensor is None


def test_pipeline_lands_raw_and_logs_text(spark, tmp_dir):
    from conftest import SF_SMALL

    from frostlake.plans.medallion import run_pipeline
    from frostlake.sources.fixtures import telemetry

    raw = f"{tmp_dir}/in"
    K.dump_json(telemetry(spark, SF_SMALL), raw)
    log = run_pipeline(spark, raw, f"{tmp_dir}/lake")
    assert spark.read.text(f"{tmp_dir}/lake/raw").count() == spark.read.text(raw).count()
    text = log.to_text()
    assert "[raw]" in text and "[staging]" in text and text.splitlines()[-1].startswith("[total]")


def test_land_raw_copy_is_packed(spark, tmp_dir):
    """The copy of JSON lines is a fraction of their bytes, line for line the same, blank lines and all."""
    from frostlake.session import path_size_bytes

    src = f"{tmp_dir}/in"
    readings = raw_df(spark, [raw_row(timestamp=str(1704110400000 + k * 1000), CO2_Level_PPM=str(k)) for k in range(300)])
    readings.selectExpr("to_json(struct(*)) AS value").coalesce(1).write.text(src)
    spark.createDataFrame([("",), (" {broken",), ("\u00fc",)], "value string").coalesce(1).write.mode("append").text(src)
    K.land_raw(spark, src, f"{tmp_dir}/raw")
    assert 4 * path_size_bytes(spark, f"{tmp_dir}/raw") < path_size_bytes(spark, src)
    lines = lambda path: sorted(r.value for r in spark.read.text(path).collect())
    assert lines(f"{tmp_dir}/raw") == lines(src)


def test_readings_of_a_large_table_are_dealt_to_tasks(spark, tmp_dir, monkeypatch):
    """One row group of events becomes readings of several tasks; rows, nulls and copies are the same."""
    from frostlake.sources import fixtures as FX

    columns = ["id AS event_id", "timestamp_seconds(1704067200 + id * 60) AS ts", "IF(id % 10 = 3, NULL, id % 7) AS user_id", "IF(id % 5 = 0, 'error', 'view') AS event_type"]
    events = spark.range(1000).selectExpr(*columns)
    events.union(events.where("event_id < 20")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    monkeypatch.setattr(FX, "TASK_BYTES", 64 * 1024, raising=False)
    got = FX.telemetry(spark, tmp_dir)
    assert got.rdd.getNumPartitions() > 4  # two, one a branch of the union, if the scan's splits are kept
    want = FX.telemetry_from_events(FX.read_events(spark, tmp_dir))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
