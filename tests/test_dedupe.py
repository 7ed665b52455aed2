"""F2 in two phases keeps the rows of the one-phase form."""

from __future__ import annotations

import pytest

from frostlake.operators.staging import drop_exact_duplicates, drop_exact_duplicates_by_digest


@pytest.mark.parametrize("limit", [4_000_000, 1])
def test_same_rows_as_one_phase(spark, limit):
    # a null does not change the digest: the second and third rows share theirs and are different
    some = [("x", "1", None), ("x", None, "1"), (None, "x", "1"), (None, None, None), ("", "", ""), ("y", "2", "3")]
    df = spark.createDataFrame(some + some[1:4] + [("hot", "h", "h")] * 50, "_digest string, `a.b` string, c string").repartition(6)
    got = drop_exact_duplicates_by_digest(df, limit)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, drop_exact_duplicates(df).collect()))


def test_empty(spark):
    assert drop_exact_duplicates_by_digest(spark.createDataFrame([], "a string, b string")).count() == 0


def test_only_repeated_readings_are_shuffled_whole(spark, tmp_dir):
    spark.range(5000).selectExpr("cast(id % 4900 as string) AS a", "repeat('z', 40) AS b").write.parquet(f"{tmp_dir}/t")
    got = drop_exact_duplicates_by_digest(spark.read.parquet(f"{tmp_dir}/t"))
    assert got.count() == 4900
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    once, suspects = plan.split("LeftSemi")[0], plan.split("LeftSemi")[1]
    assert "Aggregate" in once and "Aggregate" not in suspects and plan.count("Aggregate") == 1
    assert plan.index("LeftAnti") < plan.index("Aggregate")
