"""Drift of the raw JSON: extra keys kept, differences counted."""

from __future__ import annotations

import json

from conftest import raw_row
from pyspark.sql import functions as F

from frostlake.schema import RAW_FIELDS
from frostlake.sinks.files import write_layer
from frostlake.sources import drift as D
from frostlake.sources.lake import read_layer, read_raw_json


def lines_of(*records):
    return [r if isinstance(r, str) else json.dumps(r, separators=(",", ":")) for r in records]


def reading(drop=(), **other):
    return {k: v for k, v in {**dict(zip(RAW_FIELDS, raw_row())), **other}.items() if k not in drop}


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_fields_are_those_of_the_plain_reader(spark, tmp_dir):
    lines = lines_of(
        reading(), reading(drop=["Device_ID"]), reading(CO2_Level_PPM=512.50, extra={"a": [1, None]}), reading(LWT_Setpoint=None),
        reading(LWT_Setpoint={"x": 1}), reading(Active_Fault_Code=True), "", "   ", "not json", "[1, 2]", "7", "null", '{"Device_ID": "a", "Device_ID": "b"}', "{}",
    )
    write_text(spark, f"{tmp_dir}/raw", lines)
    got = D.read_raw_json_with_extra(spark, f"{tmp_dir}/raw").drop(D.EXTRA_COLUMN)
    want = read_raw_json(spark, f"{tmp_dir}/raw", keep_corrupt=True).drop("_corrupt_record")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_extra_keys_round_trip_through_a_layer(spark, tmp_dir):
    extras = [{"fw": "2.1", "n": 3}, {"deep": {"list": [1, {"x": None}], "s": "ü"}}, {}, {"flag": True, "none": None}]
    write_text(spark, f"{tmp_dir}/raw", lines_of(*[reading(Device_ID=str(i), **e) for i, e in enumerate(extras)], "broken"))
    write_layer(D.read_raw_json_with_extra(spark, f"{tmp_dir}/raw"), f"{tmp_dir}/batch")
    back = read_layer(spark, tmp_dir, "batch")
    got = {r.Device_ID: r.x and json.loads(r.x) for r in back.select("Device_ID", F.to_json(D.EXTRA_COLUMN).alias("x")).collect()}
    assert got == {**{str(i): e or None for i, e in enumerate(extras)}, None: None}
    (schema,) = D.observed_schema(back).first()
    assert schema == "OBJECT<deep: OBJECT<list: ARRAY<VARIANT>, s: STRING>, flag: BOOLEAN, fw: STRING, n: BIGINT, none: VOID>"


def test_drift_is_counted_by_key_and_kind(spark):
    lines = lines_of(
        reading(), reading(a="x"), reading(a="y", b=1), reading(a=2.5), reading(CO2_Level_PPM=5), reading(CO2_Level_PPM=[5]),
        reading(CO2_Level_PPM=None), reading(drop=["timestamp", "Device_ID"]), "oops", "[]", "{}",
    )
    found = D.schema_drift(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    got = {(r.key, r.drift, r.type): r.records for r in found}
    missing = {(f, "missing", None): 1 for f in RAW_FIELDS}
    missing |= {("timestamp", "missing", None): 2, ("Device_ID", "missing", None): 2}
    assert got == missing | {
        ("a", "added", "STRING"): 2, ("a", "added", "DECIMAL"): 1, ("b", "added", "BIGINT"): 1,
        ("CO2_Level_PPM", "retyped", "BIGINT"): 1, ("CO2_Level_PPM", "retyped", "ARRAY"): 1, (None, "malformed", None): 2,
    }


def test_no_lines(spark, tmp_dir):
    write_text(spark, f"{tmp_dir}/raw", ["", " "])
    lines = D.raw_lines(spark, f"{tmp_dir}/raw")
    assert D.schema_drift(lines).collect() == [] and D.with_extra(lines).collect() == []
    assert D.observed_schema(D.with_extra(lines)).first().schema in (None, "VOID")


def test_extra_of_lines_that_only_one_reader_takes(spark):
    """Keys are listed first and members are parsed only of lines with other keys; what is no object, has a key twice or
    is cut off has no extra. A known key's value plays no part."""
    lines = ['{"a":1}', " {\"a\":1}", '{"a":1,"a":2}', '{"a":1} x', '{"a":1', "{'a':1}", '{"a":NaN}', '["a"]', "null", "", '{"Device_ID":{"a":1}}', '{"device_id":1}', '{"":1}', '{"a":null}']
    df = D.with_extra(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [r.x and json.loads(r.x) for r in df.select(F.to_json(D.EXTRA_COLUMN).alias("x")).collect()]
    one = {"a": 1}  # what follows an object is not read
    assert got == [one, one, None, one, None, None, None, None, None, None, None, {"device_id": 1}, {"": 1}, {"a": None}]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan  # a hash set is looked into instead
