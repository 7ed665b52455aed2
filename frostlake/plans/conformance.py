"""Free-SQL conformance queries over the lake views.

The free SQL endpoint (``serving.run_sql``) accepts any query, so joins,
windows, grouping sets, set operations and subqueries over the lake views are
capabilities of the engine even though no pipeline stage uses them. Each
query below is a plain ``spark.sql`` over the views ``silver`` and
``gold_<table>``; the same text (null ordering written out, since the engines'
defaults differ) runs on DuckDB as the oracle.
"""

from __future__ import annotations


def _r2(x: str) -> str:
    return f"COALESCE(CAST(ROUND(TRY_CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE), ROUND({x}, 2))"


# key -> (SQL text, gold tables it reads); texts that name `silver` also read it
CONFORMANCE: dict[str, tuple[str, tuple[str, ...]]] = {
    "sql_join_fault_dim": (
        "SELECT f.timestamp_formatted, f.Device_ID, f.Active_Fault_Code, f.Setpoint_Deviation, "
        "f.SLA_Breach_Flag, d.Asset_Health_Status "
        "FROM gold_fact_fault_events f "
        "JOIN gold_dim_fault_codes d ON f.Active_Fault_Code = d.Active_Fault_Code",
        ("fact_fault_events", "dim_fault_codes"),
    ),
    "sql_left_join_costs_breaches": (
        "SELECT c.Date, c.Device_ID, c.Daily_Cost_USD, c.Daily_Power_kW, s.Total_Breaches, s.Max_Deviation "
        "FROM gold_mart_daily_costs c "
        "LEFT JOIN gold_mart_sla_breach_summary s ON c.Date = s.Date AND c.Device_ID = s.Device_ID",
        ("mart_daily_costs", "mart_sla_breach_summary"),
    ),
    "sql_anti_join_devices": (
        "SELECT c.Date, c.Device_ID, c.Daily_Cost_USD FROM gold_mart_daily_costs c "
        "WHERE NOT EXISTS (SELECT 1 FROM gold_mart_sla_breach_summary s "
        "WHERE s.Date = c.Date AND s.Device_ID = c.Device_ID AND s.Total_Breaches > 5)",
        ("mart_daily_costs", "mart_sla_breach_summary"),
    ),
    "sql_rank_cost": (
        "SELECT Date, Device_ID, Daily_Cost_USD, rn FROM ("
        "SELECT Date, Device_ID, Daily_Cost_USD, CAST(ROW_NUMBER() OVER (PARTITION BY Date "
        "ORDER BY Daily_Cost_USD DESC NULLS LAST, Device_ID ASC NULLS LAST) AS BIGINT) AS rn "
        "FROM gold_mart_daily_costs) t WHERE rn <= 3",
        ("mart_daily_costs",),
    ),
    "sql_moving_avg": (
        "SELECT Device_ID, Date, Daily_Cost_USD, "
        + _r2(
            "AVG(Daily_Cost_USD) OVER (PARTITION BY Device_ID ORDER BY Date ASC NULLS LAST "
            "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
        )
        + " AS cost_3day_avg FROM gold_mart_daily_costs",
        ("mart_daily_costs",),
    ),
    "sql_rollup_cost": (
        f"SELECT Date, Device_ID, {_r2('SUM(Daily_Cost_USD)')} AS total_cost, "
        "CAST(COUNT(*) AS BIGINT) AS device_days "
        "FROM gold_mart_daily_costs GROUP BY ROLLUP(Date, Device_ID)",
        ("mart_daily_costs",),
    ),
    "sql_set_ops": (
        "SELECT Device_ID FROM silver EXCEPT "
        "SELECT Device_ID FROM gold_fact_fault_events WHERE Active_Fault_Code = '4'",
        ("fact_fault_events",),
    ),
    "sql_union_devices": (
        "SELECT Device_ID, 'faulted' AS kind FROM gold_fact_fault_events WHERE Active_Fault_Code != '0' "
        "UNION "
        "SELECT Device_ID, 'breached' AS kind FROM gold_mart_sla_breach_summary WHERE Total_Breaches > 5",
        ("fact_fault_events", "mart_sla_breach_summary"),
    ),
    "sql_intersect_devices": (
        "SELECT Device_ID, Date FROM gold_mart_sla_breach_summary WHERE Total_Breaches > 5 "
        "INTERSECT "
        "SELECT Device_ID, Date FROM gold_mart_filter_diagnostics WHERE Filter_Alerts > 8",
        ("mart_sla_breach_summary", "mart_filter_diagnostics"),
    ),
    "sql_scalar_subquery": (
        "SELECT f.Device_ID, f.Date, f.Hour_of_Day, f.Avg_Power_kW FROM gold_fact_hourly_telemetry f "
        "WHERE f.Avg_Power_kW > (SELECT AVG(g.Avg_Power_kW) FROM gold_fact_hourly_telemetry g "
        "WHERE g.Device_ID = f.Device_ID)",
        ("fact_hourly_telemetry",),
    ),
    "sql_lag_cost_change": (
        "SELECT Device_ID, Date, Daily_Cost_USD, "
        + _r2(
            "Daily_Cost_USD - LAG(Daily_Cost_USD) OVER (PARTITION BY Device_ID ORDER BY Date ASC NULLS LAST)"
        )
        + " AS cost_change FROM gold_mart_daily_costs",
        ("mart_daily_costs",),
    ),
    "sql_three_way_join": (
        "SELECT c.Device_ID, c.Date, c.Daily_Cost_USD, s.Total_Breaches, f.Filter_Alerts, h.Avg_EER "
        "FROM gold_mart_daily_costs c "
        "JOIN gold_mart_sla_breach_summary s ON s.Device_ID = c.Device_ID AND s.Date = c.Date "
        "JOIN gold_mart_filter_diagnostics f ON f.Device_ID = c.Device_ID AND f.Date = c.Date "
        "JOIN gold_mart_cooling_efficiency h ON h.Device_ID = c.Device_ID AND h.Date = c.Date "
        "WHERE s.Total_Breaches > 3",
        ("mart_daily_costs", "mart_sla_breach_summary", "mart_filter_diagnostics", "mart_cooling_efficiency"),
    ),
    "sql_grouping_sets_shift": (
        "SELECT Date, Operational_Shift, CAST(GROUPING_ID(Date, Operational_Shift) AS BIGINT) AS gid, "
        f"{_r2('AVG(Avg_Power_kW)')} AS avg_power, CAST(COUNT(*) AS BIGINT) AS hours "
        "FROM gold_fact_hourly_telemetry GROUP BY GROUPING SETS ((Date, Operational_Shift), (Operational_Shift), ())",
        ("fact_hourly_telemetry",),
    ),
}

# The free-SQL example: all rows come back, as nobody asks for a cap.
RUN_SQL_EXAMPLE = (
    "SELECT Device_ID, Date, Hour_of_Day, Avg_Power_kW, Total_Cost_USD FROM gold_fact_hourly_telemetry "
    "ORDER BY Device_ID ASC NULLS LAST, Date ASC NULLS LAST, Hour_of_Day ASC NULLS LAST;"
)
RUN_SQL_TABLES = ("fact_hourly_telemetry",)
