"""Atomic overwrite: a layer is one whole version or another, never a part."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from frostlake.sinks.files import SchemaMismatch, lake_manifest, write_layer
from frostlake.sources import versions as V
from frostlake.sources.lake import TableNotFound, list_lake_tables, read_layer


def numbers(df):
    return sorted(r.id for r in df.collect())


def failing(spark, n=40):
    """Rows whose last partition raises while they are written."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))


def test_a_failed_write_leaves_the_old_version(spark, tmp_dir):
    write_layer(spark.range(5), f"{tmp_dir}/silver")
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark), f"{tmp_dir}/silver")
    assert numbers(read_layer(spark, tmp_dir, "silver")) == list(range(5))
    assert len(V.committed(spark, f"{tmp_dir}/silver")) == 1
    # the next write succeeds, and what the failed one left goes with the versions before
    for n in (6, 7):
        write_layer(spark.range(n), f"{tmp_dir}/silver")
    assert numbers(read_layer(spark, tmp_dir, "silver")) == list(range(7))
    assert len(glob.glob(f"{tmp_dir}/silver/v*")) == V.KEEP


def test_a_failed_first_write_is_no_table(spark, tmp_dir):
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark), f"{tmp_dir}/gold/mart")
    assert list_lake_tables(spark, tmp_dir) == []
    write_layer(spark.range(2), f"{tmp_dir}/gold/mart")
    assert list_lake_tables(spark, tmp_dir) == [("gold", "mart")]


def test_a_killed_write_is_not_seen(spark, tmp_dir):
    """All files are there, but the process ended before the commit."""
    layer = f"{tmp_dir}/silver"
    write_layer(spark.range(3), layer)
    dead = V.new_version(spark, layer)
    spark.range(100).write.parquet(f"{layer}/{dead}")
    assert numbers(read_layer(spark, tmp_dir, "silver")) == [0, 1, 2]
    assert not any(dead in r.path for r in lake_manifest(spark, tmp_dir, hidden=True).collect())


def test_a_reader_keeps_the_version_it_began_on(spark, tmp_dir):
    layer = f"{tmp_dir}/silver"
    write_layer(spark.range(3), layer)
    reader = read_layer(spark, tmp_dir, "silver")
    half = V.new_version(spark, layer)
    spark.range(50).write.parquet(f"{layer}/{half}")  # a write on its way
    assert numbers(reader) == numbers(read_layer(spark, tmp_dir, "silver")) == [0, 1, 2]
    V.commit(spark, layer, half)
    assert numbers(reader) == [0, 1, 2] and read_layer(spark, tmp_dir, "silver").count() == 50


def test_old_versions_go_and_the_manifest_lists_the_current_one(spark, tmp_dir):
    layer = f"{tmp_dir}/gold/mart"
    for n in range(1, 6):
        write_layer(spark.range(n), layer)
    versions = V.committed(spark, layer)
    assert len(versions) == V.KEEP and sorted(os.listdir(f"{layer}/_commits"))[-1] == versions[-1]
    assert sorted(n for n in os.listdir(layer) if n.startswith("v")) == versions
    listed = lake_manifest(spark, tmp_dir, hidden=True).collect()
    assert listed and all(versions[-1] in r.path for r in listed)
    assert any(r.relative_path == f"gold/mart/_commits/{versions[-1]}" for r in listed)


def test_a_layer_without_versions_is_read_and_replaced(spark, tmp_dir):
    layer = f"{tmp_dir}/staging"
    spark.range(4).withColumn("x", F.lit(1)).write.partitionBy("id").parquet(layer)
    assert read_layer(spark, tmp_dir, "staging").count() == 4
    with pytest.raises(SchemaMismatch):
        write_layer(spark.range(2), layer)
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark), layer, overwrite_schema=True)
    assert read_layer(spark, tmp_dir, "staging").count() == 4
    write_layer(spark.range(9), layer, overwrite_schema=True)
    assert numbers(read_layer(spark, tmp_dir, "staging")) == list(range(9))
    assert sorted(n[0] for n in os.listdir(layer)) == ["_", "v"]


def test_two_writers(spark, tmp_dir):
    """The later version stays, whichever commits last; one that was overtaken and removed cannot commit."""
    layer = f"{tmp_dir}/silver"
    a = V.new_version(spark, layer)
    spark.range(1).write.parquet(f"{layer}/{a}")
    b = V.new_version(spark, layer)
    spark.range(2).write.parquet(f"{layer}/{b}")
    V.commit(spark, layer, b)
    assert numbers(read_layer(spark, tmp_dir, "silver")) == [0, 1]
    with pytest.raises(RuntimeError, match="gone"):
        V.commit(spark, layer, a)
    with pytest.raises(RuntimeError, match="before"):
        V.commit(spark, layer, b)
    with pytest.raises(TableNotFound):
        read_layer(spark, tmp_dir, "batch")
