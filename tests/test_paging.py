"""Q5 by bookmark: the pages are those of offset paging."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from frostlake.plans.paging import Bookmark, next_bookmark, seek_page
from frostlake.plans.serving import page_table


def walk(df, limit, order_by=None):
    after, pages = None, []
    while True:
        page = seek_page(df, limit, after, order_by).collect()
        if not page:
            return pages, after
        after = next_bookmark(page, df, after, order_by)
        pages.append([str(r) for r in page])


def mixed(spark):
    rng = random.Random(3)
    values = [None, float("nan"), float("-inf"), -1.5, 0.0, 2.25]
    rows = [(rng.choice([None, "", "a", "b"]), rng.choice(values), rng.choice([None, True, False])) for _ in range(60)]
    return spark.createDataFrame(rows + [("b", 2.25, True)] * 17, "`k.x` string, v double, b boolean").repartition(5)


def test_pages_equal_offset_pages(spark):
    df = mixed(spark).cache()
    for limit, order_by in ((7, None), (10, ["v"]), (77, ["b", "v"])):
        pages, _ = walk(df, limit, order_by)
        offset = [[str(r) for r in page_table(df, k + 1, limit, order_by).collect()] for k in range(len(pages))]
        assert pages == offset and sum(map(len, pages)) == 77


def test_rows_added_before_the_bookmark_shift_nothing(spark):
    df = spark.range(30).withColumn("g", F.col("id") % 3)
    page = seek_page(df, 12, None, ["id"]).collect()
    after = next_bookmark(page, df, None, ["id"])
    more = df.unionByName(spark.createDataFrame([(-1, 0), (5, 9)], "id long, g long"))
    assert [r.id for r in seek_page(more, 5, after, ["id"]).collect()] == [12, 13, 14, 15, 16]


def test_ends_and_empty_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert walk(empty, 5) == ([], None) and seek_page(empty, 5, Bookmark((1, "x"), 1)).collect() == []
    df = spark.range(4)
    _, end = walk(df, 2)
    assert end == Bookmark((3,), 1) and next_bookmark([], df, end) == end and seek_page(df, 0).collect() == []


def test_scan_is_filtered_and_not_sorted_whole(spark, tmp_dir):
    spark.range(1000).withColumn("s", F.col("id").cast("string")).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    plan = seek_page(df, 10, Bookmark((900, "900"), 1), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,900)" in plan and "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
