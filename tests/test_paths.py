"""Path helpers follow Spark's own file systems."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from frostlake.session import delete_path, list_subdirs, path_exists, path_size_bytes
from frostlake.sinks.files import SchemaMismatch, lake_manifest, write_layer
from frostlake.sources.lake import TableNotFound, read_layer
from frostlake.streaming.state import has_state, read_state, start_newest


@pytest.fixture()
def mounted(spark, tmp_dir):
    """``/lake`` without a scheme is a folder of a view file system, not of this machine's root."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    name = f"lakes{uuid.uuid4().hex[:8]}"  # file systems are cached by name, and this one's folder is the test's own
    conf.set(f"fs.viewfs.mounttable.{name}.link./lake", f"file://{tmp_dir}")
    conf.set("fs.defaultFS", f"viewfs://{name}/")
    yield tmp_dir
    conf.set("fs.defaultFS", old)


def test_path_without_scheme_is_on_the_default_file_system(spark, mounted):
    write_layer(spark.range(3), "/lake/silver")
    assert os.path.isdir(f"{mounted}/silver") and not os.path.exists("/lake")
    assert path_exists(spark, "/lake/silver") and list_subdirs(spark, "/lake") == ["silver"]
    assert path_size_bytes(spark, "/lake/silver") > 0 and path_size_bytes(spark, "/lake/none") is None
    assert read_layer(spark, "/lake", "silver").count() == 3
    with pytest.raises(TableNotFound):
        read_layer(spark, "/lake", "staging")
    with pytest.raises(SchemaMismatch):
        write_layer(spark.range(3).selectExpr("id AS other"), "/lake/silver")
    delete_path(spark, "/lake/silver")
    assert not os.path.exists(f"{mounted}/silver")


def test_live_state_is_on_the_default_file_system(spark, mounted):
    schema = "seq long, Entering_Chilled_Water_Temperature_Sensor double"
    spark.createDataFrame([(i, 70.0) for i in range(6)], schema).write.json("/lake/messages")
    assert not has_state(spark, "/lake/views")
    start_newest(spark.readStream.schema(schema).json("/lake/messages"), "/lake/views", 2, "seq", F.lit(True), available_now=True).awaitTermination()
    assert has_state(spark, "/lake/views") and os.path.isdir(f"{mounted}/views/state")
    assert sum(r.messages for r in read_state(spark, "/lake/views", "seen").collect()) == 6


def test_manifest_names_hidden_files_too(spark, tmp_dir):
    spark.range(4).write.parquet(f"{tmp_dir}/gold/t")
    spark.range(4).write.parquet(f"{tmp_dir}/gold/t/_delta_log/deep")
    found = {r.relative_path: r.length for r in lake_manifest(spark, tmp_dir, hidden=True).collect()}
    want = {}
    for folder, _, names in os.walk(tmp_dir):
        for name in names:
            path = os.path.join(folder, name)
            if not name.endswith(".crc"):  # the local file system's own sums, which it hides
                want[os.path.relpath(path, tmp_dir)] = os.path.getsize(path)
    assert found == want and any("_SUCCESS" in p for p in found)
