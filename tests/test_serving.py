"""Serving: free SQL cap and read-only rule, paging, catalogue, lake views."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL

from frostlake.plans import serving as S
from frostlake.plans.medallion import run_pipeline
from frostlake.sources.fixtures import telemetry
from frostlake.sources.lake import TableNotFound, read_layer


@pytest.fixture(scope="module")
def lake(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="frostlake-lake-")
    run_pipeline(spark, telemetry(spark, SF_SMALL), root)
    S.register_lake_views(spark, root)
    return root


def test_run_sql_caps_only_when_asked(spark, lake):
    n_silver = spark.table("silver").count()
    assert S.run_sql(spark, " SELECT * FROM silver ; ").count() == n_silver
    assert S.run_sql(spark, "SELECT * FROM silver;", cap=100).count() == 100
    assert S.run_sql(spark, "SELECT id AS limit FROM range(5000)").count() == 5000
    some = S.query_response(spark, lake, "SELECT id AS limit FROM range(50)", cap=20)
    assert len(some["data"]) == 20 and some["truncated"]
    assert not S.query_response(spark, lake, "SELECT id FROM range(20)", cap=20)["truncated"]


def test_run_sql_takes_unnamed_and_equal_columns(spark, lake):
    assert S.run_sql(spark, "SELECT 1.5, sum(id * 0.12) FROM range(3) GROUP BY id % 2").count() == 2
    both = S.run_sql(spark, "SELECT * FROM range(3) a JOIN (SELECT id, CAST('NaN' AS DOUBLE) AS x FROM range(3)) b ON a.id = b.id")
    assert both.columns == ["id", "id", "x"] and [tuple(r) for r in both.collect()] == [(i, i, None) for i in range(3)]


def test_run_sql_with_cte_and_order(spark, lake):
    rows = S.run_sql(
        spark,
        "WITH d AS (SELECT Device_ID, Daily_Cost_USD FROM gold_mart_daily_costs) "
        "SELECT Device_ID, SUM(Daily_Cost_USD) AS c FROM d GROUP BY Device_ID ORDER BY c DESC",
    ).collect()
    assert [r.c for r in rows] == sorted((r.c for r in rows), reverse=True)


def test_run_sql_is_read_only(spark, lake):
    for bad in ("DROP VIEW silver", "CREATE TABLE x AS SELECT 1", "INSERT INTO x VALUES (1)"):
        with pytest.raises(Exception):
            S.run_sql(spark, bad)
    assert spark.table("silver").count() > 0


def test_run_sql_nan_to_null(spark, lake):
    row = S.run_sql(spark, "SELECT CAST('NaN' AS DOUBLE) AS x, 1.5D AS y").collect()[0]
    assert row.x is None and row.y == 1.5


def test_paging_is_stable_and_complete(spark, lake):
    df = spark.table("gold_mart_daily_costs")
    total = S.count_table(df).collect()[0].total
    pages = []
    page = 1
    while True:
        rows = S.page_table(df, page=page, limit=7).collect()
        pages.extend(tuple(r) for r in rows)
        if not S.has_next_page(total, page, 7):
            break
        page += 1
    assert len(pages) == total == len(set(pages))
    assert S.page_table(df, page=page + 1, limit=7).count() == 0


def test_has_next_page_exact_multiple():
    assert S.has_next_page(100, 1, 50)
    assert not S.has_next_page(100, 2, 50)


def test_catalogue_and_missing_layer(spark, lake):
    cat = {(r.layer, r.table) for r in S.list_tables(spark, lake).collect()}
    assert ("silver", None) in cat and ("gold", "fact_fault_events") in cat and len(cat) == 18
    assert S.list_tables(spark).count() == 18
    with pytest.raises(TableNotFound):
        read_layer(spark, lake, "gold", "no_such_table")
    with pytest.raises(TableNotFound):
        read_layer(spark, lake, "platinum")


def test_register_skips_missing_layers(spark, tmp_dir):
    assert S.register_lake_views(spark, tmp_dir) == []


def test_dashboard_totals_null_is_zero(spark):
    costs = spark.createDataFrame([], "Date date, Device_ID string, Daily_Cost_USD double, Daily_Power_kW double")
    sla = spark.createDataFrame([], "Device_ID string, Date date, Total_Breaches bigint, Max_Deviation double")
    row = S.dashboard_totals(costs, sla).collect()[0]
    assert (row.total_cost, row.total_power, row.total_breaches) == (0.0, 0.0, 0)


def test_response_shapes(spark, lake):
    page = S.table_page_response(spark, lake, "gold", "mart_daily_costs", page=2, limit=10)
    assert len(page["data"]) == 10 and page["pagination"]["page"] == 2
    assert page["pagination"]["total"] == spark.table("gold_mart_daily_costs").count()
    assert set(page["data"][0]) == {"Date", "Device_ID", "Daily_Cost_USD", "Daily_Power_kW"}
    silver_page = S.table_page_response(spark, lake, "silver", "ignored", limit=5)
    assert len(silver_page["data"]) == 5
    q = S.query_response(spark, lake, "SELECT Device_ID, COUNT(*) AS n FROM silver GROUP BY Device_ID;")
    assert sum(r["n"] for r in q["data"]) == spark.table("silver").count()
    dash = S.dashboard_response(spark, lake)
    assert {"daily_costs", "sla_breaches", "hourly_temperatures"} == set(dash["metrics"])
    assert dash["totals"]["total_breaches"] == sum(r["total_breaches"] for r in dash["metrics"]["sla_breaches"])
    dates = [r["Date"] for r in dash["metrics"]["daily_costs"]]
    assert dates == sorted(dates)


def test_pages_by_a_partial_key_fit_together(spark):
    df = spark.range(60).selectExpr("id % 3 AS k", "id AS v").repartition(7)
    rows = [tuple(r) for page in (1, 2, 3, 4) for r in S.page_table(df, page, 20, order_by=["k"]).collect()]
    assert rows == sorted((i % 3, i) for i in range(60))


def test_format_detection(spark, lake, tmp_dir):
    from frostlake.sources.lake import delta_available, lake_format, resolve_format

    assert lake_format(spark, lake) == "parquet"
    os.makedirs(f"{tmp_dir}/dl/silver/_delta_log")
    assert lake_format(spark, f"{tmp_dir}/dl") == "delta"
    assert resolve_format(spark, "parquet") == "parquet"
    assert resolve_format(spark, "auto") == ("delta" if delta_available(spark) else "parquet")
