"""Each way a source can fail, what replaces it, and what is recorded."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from frostlake.sources import resolution as R

SCHEMA = "id long"


@pytest.fixture()
def given(spark):
    return spark.range(100, 103)


def resolve(spark, given, source, **options):
    return R.resolve_source(spark, "feed", source, given, **options)


def test_a_source_with_rows_is_used(spark, given):
    primary = spark.range(3)
    found = resolve(spark, given, lambda: primary)
    assert found.df is primary and (found.used, found.reason, found.detail) == ("primary", R.OK, None)


@pytest.mark.parametrize("reason", [R.PATH_MISSING, R.EMPTY, R.READ_ERROR, R.UNREACHABLE])
def test_each_failure_gives_the_fallback_and_its_reason(spark, given, tmp_dir, reason):
    path = f"{tmp_dir}/feed"
    if reason == R.EMPTY:
        os.makedirs(path)
    if reason == R.READ_ERROR:
        spark.range(50).select(F.col("id").cast("string").alias("value")).write.text(path)
    before = sorted(os.listdir(path)) if os.path.exists(path) else None
    source = {
        R.UNREACHABLE: lambda: spark.read.format("kafka").option("kafka.bootstrap.servers", "localhost:1").option("subscribe", "t").load(),
        R.EMPTY: lambda: spark.read.parquet(path),  # a folder without files has no schema
    }.get(reason, lambda: spark.read.schema(SCHEMA).parquet(path))
    found = resolve(spark, given, source)
    assert found.df is given and (found.used, found.reason) == ("fallback", reason) and found.detail
    # nothing is written to the source
    assert (sorted(os.listdir(path)) if os.path.exists(path) else None) == before
    with pytest.raises(R.SourceFailed, match=reason):
        resolve(spark, given, source, on=[x for x in R.FAILURES if x != reason])


def test_no_rows(spark, given):
    found = resolve(spark, given, lambda: spark.range(0))
    assert (found.used, found.reason) == ("fallback", R.EMPTY)


def test_the_probe_ends_in_time(spark, given):
    slow = lambda: spark.range(0, 4, 1, 4).where(F.expr("length(java_method('java.lang.Thread', 'sleep', 20000L)) > 99"))
    began = time.time()
    found = resolve(spark, given, slow, timeout=2.0)
    assert (found.used, found.reason) == ("fallback", R.TIMEOUT) and time.time() - began < 15
    assert resolve(spark, given, lambda: spark.range(1)).used == "primary"  # later jobs are not cancelled


def test_mistakes_are_raised(spark, given):
    with pytest.raises(AnalysisException):
        resolve(spark, given, lambda: spark.range(1).select("no_such_column"))
    with pytest.raises(ZeroDivisionError):
        resolve(spark, given, lambda: 1 // 0)
    with pytest.raises(ValueError):
        resolve(spark, given, lambda: spark.range(1), on=["late"])


def test_the_decision_is_recorded(spark, given, tmp_dir):
    resolve(spark, given, lambda: spark.read.schema(SCHEMA).json(f"{tmp_dir}/none")).append_to(spark, f"{tmp_dir}/_sources")
    resolve(spark, given, lambda: spark.range(1)).append_to(spark, f"{tmp_dir}/_sources")
    rows = spark.read.parquet(f"{tmp_dir}/_sources").orderBy("resolved_at").collect()
    assert [(r.source, r.used, r.reason) for r in rows] == [("feed", "fallback", R.PATH_MISSING), ("feed", "primary", R.OK)]
    assert "none" in rows[0].detail and rows[0].seconds >= 0


def test_pipeline_with_a_fallback_and_a_drift_report(spark, tmp_dir):
    from conftest import SF_SMALL

    from frostlake.plans.medallion import PipelineConfig, run_pipeline
    from frostlake.sinks.files import dump_json
    from frostlake.sources.fixtures import telemetry
    from frostlake.sources.lake import read_layer

    given = telemetry(spark, SF_SMALL)
    log = run_pipeline(spark, f"{tmp_dir}/none", f"{tmp_dir}/lake", PipelineConfig(drift_report=True), fallback=given)
    assert log.entries[0][2] == "source/path_missing" and not os.path.exists(f"{tmp_dir}/none")
    assert read_layer(spark, f"{tmp_dir}/lake", "batch").count() == given.count()
    dump_json(given.limit(40), f"{tmp_dir}/raw")
    run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake", PipelineConfig(drift_report=True), fallback=given)
    assert read_layer(spark, f"{tmp_dir}/lake", "batch").count() == 40
    used = spark.read.parquet(f"{tmp_dir}/lake/_sources").orderBy("resolved_at").select("used").collect()
    assert [r.used for r in used] == ["fallback", "primary"]
    assert spark.read.parquet(f"{tmp_dir}/lake/_drift").count() == 0
