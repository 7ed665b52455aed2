"""The layout that the pipeline gives silver."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from frostlake.operators.silver import DEFAULT_RULES, silver
from frostlake.operators.staging import staging
from frostlake.plans.medallion import PipelineConfig, clustered, run_pipeline
from frostlake.sources.fixtures import telemetry
from frostlake.sources.lake import read_layer
from tests.conftest import SF_SMALL


def test_day_partitioned_silver_has_few_files(spark, tmp_dir):
    run_pipeline(spark, telemetry(spark, SF_SMALL), f"{tmp_dir}/lake", PipelineConfig(silver_partition_by=("Date",)))
    days = glob.glob(f"{tmp_dir}/lake/silver/v*/Date=*")
    files = glob.glob(f"{tmp_dir}/lake/silver/v*/Date=*/part-*")
    # each range boundary cuts at most one day
    assert days and len(files) <= len(days) + 8
    assert read_layer(spark, f"{tmp_dir}/lake", "silver").count() == read_layer(spark, f"{tmp_dir}/lake", "staging").count()


def test_hot_device_hour_is_split(spark):
    one = spark.range(4000).select(
        F.lit("2024-01-01").cast("date").alias("Date"), F.lit(3).alias("Hour_of_Day"), F.lit("CHILLER_01").alias("Device_ID"),
        F.col("id").cast("string").alias("timestamp"),
    )
    sizes = [r["count"] for r in clustered(one, 4).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_pipeline_shuffles_staging_not_silver(spark):
    stg = staging(telemetry(spark, SF_SMALL))
    plan = silver(clustered(stg, 4, DEFAULT_RULES))
    assert sorted(map(str, plan.collect())) == sorted(map(str, silver(stg).collect()))
    below = plan._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "Estimated_Hourly_Cost_USD" not in below
    # each range holds whole day-hour-device spans, but for the two at its ends
    spans = plan.withColumn("part", F.spark_partition_id()).groupBy("Date", "Hour_of_Day", "Device_ID").agg(F.countDistinct("part").alias("n"))
    assert spans.where("n > 1").count() <= 3
