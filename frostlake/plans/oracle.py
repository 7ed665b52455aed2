"""DuckDB texts of every relational query, for the correctness gate.

DuckDB only sees the driver's tables, so each text is a chain of CTEs:
``telemetry`` (over ``events``) -> ``staging`` -> ``silver`` -> gold table(s)
-> the query. The Spark half of each query is written with the DataFrame API
in ``frostlake.operators`` / ``frostlake.plans``; only the fixture
expressions are shared.

Type alignment with Spark: ``SUM`` of integers is cast to BIGINT (DuckDB
gives HUGEINT), ``hour()`` to INTEGER, and timestamps are plain (naive, UTC)
``TIMESTAMP`` values.
"""

from __future__ import annotations

from frostlake.functions.columns import MAX_EPOCH_SECONDS, MIN_EPOCH_SECONDS
from frostlake.schema import CRITICAL_COLUMNS, RAW_FIELDS, SENSOR_DOUBLE_COLUMNS
from frostlake.sources.fixtures import live_sql, telemetry_sql


def q(name: str) -> str:
    return f'"{name}"'


def round2(x: str) -> str:
    return f"COALESCE(CAST(ROUND(TRY_CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE), ROUND({x}, 2))"


def _staging() -> str:
    cond = " AND ".join(f"{q(c)} IS NOT NULL" for c in CRITICAL_COLUMNS)
    return f"SELECT DISTINCT * FROM telemetry WHERE {cond}"


def _cast_sensors(src: str) -> str:
    typed = set(SENSOR_DOUBLE_COLUMNS)
    cols = [f"TRY_CAST({q(c)} AS DOUBLE) AS {q(c)}" if c in typed else q(c) for c in RAW_FIELDS]
    cols.append(f"TRY_CAST({q('Cumulated_Pump_2_Hours_Sensor')} AS DOUBLE) AS {q('Pump_Hours')}")
    return f"SELECT {', '.join(cols)} FROM {src}"


def _silver() -> str:
    secs = f"TRY_CAST(trunc(TRY_CAST({q('timestamp')} AS DOUBLE) / 1000) AS BIGINT)"
    ts = f"CASE WHEN __s BETWEEN {MIN_EPOCH_SECONDS} AND {MAX_EPOCH_SECONDS} THEN epoch_ms(__s * 1000) END"
    ent, lea = q("Entering_Chilled_Water_Temperature_Sensor"), q("Leaving_Chilled_Water_Temperature_Sensor")
    dev = round2(f"{lea} - {q('Leaving_Chilled_Water_Temperature_Setpoint')}")
    hour = "CAST(hour(__ts) AS INTEGER)"
    derived = [
        f"__ts AS {q('timestamp_formatted')}",
        f"CAST(__ts AS DATE) AS {q('Date')}",
        f"{hour} AS {q('Hour_of_Day')}",
        f"CASE WHEN {hour} >= 6 AND {hour} < 14 THEN 'Morning' "
        f"WHEN {hour} >= 14 AND {hour} < 22 THEN 'Afternoon' ELSE 'Night' END AS {q('Operational_Shift')}",
        f"{round2(f'{ent} - {lea}')} AS {q('Cooling_Capacity_Delta')}",
        f"{dev} AS {q('Setpoint_Deviation')}",
        f"CASE WHEN {dev} > 2.0 THEN 1 ELSE 0 END AS {q('SLA_Breach_Flag')}",
        f"{round2(q('System_Power_Consumption_kW') + ' * 0.12')} AS {q('Estimated_Hourly_Cost_USD')}",
        f"{round2('(' + q('VFD_Frequency_Hz') + ' / 60.0) * 100')} AS {q('System_Load_Percentage')}",
        f"{round2(q('Compressor_1_Current_Amps') + ' + ' + q('Compressor_2_Current_Amps'))} "
        f"AS {q('Total_Compressor_Amps')}",
        f"CASE WHEN {q('CO2_Level_PPM')} > 600 THEN 'Poor' ELSE 'Good' END AS {q('Air_Quality_Status')}",
        f"CASE WHEN {q('Filter_Pressure_Drop_Pa')} > 120 THEN 'Replace Filter' ELSE 'None' END "
        f"AS {q('Maintenance_Recommendation')}",
        f"CASE WHEN {q('Active_Fault_Code')} = '0' THEN 'Healthy' ELSE 'Critical' END AS {q('Asset_Health_Status')}",
        f"{round2(lea + ' - ' + q('Refrigerant_Suction_Temperature'))} AS {q('Evaporator_Approach_Temp')}",
        f"{round2(q('Refrigerant_Discharge_Temperature') + ' - ' + q('Cooling_Tower_Water_Temperature'))} "
        f"AS {q('Condenser_Approach_Temp')}",
        f"{round2(q('Return_Air_Temperature_Sensor') + ' - ' + q('Supply_Air_Temperature_Sensor'))} "
        f"AS {q('Air_Cooling_Delta')}",
    ]
    typed_cols = [q(c) for c in RAW_FIELDS] + [q("Pump_Hours")]
    with_ts = f"SELECT *, {ts} AS __ts FROM (SELECT *, {secs} AS __s FROM silver_typed)"
    return f"SELECT {', '.join(typed_cols)}, {', '.join(derived)} FROM ({with_ts})"


def _sum_int(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def _count_when(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_POOR = _count_when("Air_Quality_Status = 'Poor'")
_RELAY_OFF = _count_when("Pump_Relay_1_Status = '0'")
_REPLACE = _count_when("Maintenance_Recommendation = 'Replace Filter'")

GOLD_SQL: dict[str, str] = {
    "dim_device": "SELECT DISTINCT Device_ID, Cooler_Fluid_Type_Select_Status, Pump_Control_Parameter, "
    "Pump_Shutdhow_Daily_Setpoint FROM silver",
    "dim_time": "SELECT DISTINCT Date, Hour_of_Day, Operational_Shift FROM silver",
    "dim_fault_codes": "SELECT DISTINCT Active_Fault_Code, Asset_Health_Status FROM silver",
    "dim_status_flags": "SELECT DISTINCT Air_Quality_Status, Maintenance_Recommendation FROM silver",
    "fact_hourly_telemetry": "SELECT Device_ID, Date, Hour_of_Day, Operational_Shift, "
    f"{round2('AVG(Entering_Chilled_Water_Temperature_Sensor)')} AS Avg_Entering_Temp, "
    f"{round2('AVG(Leaving_Chilled_Water_Temperature_Sensor)')} AS Avg_Leaving_Temp, "
    f"{round2('AVG(System_Power_Consumption_kW)')} AS Avg_Power_kW, "
    f"{round2('SUM(Estimated_Hourly_Cost_USD)')} AS Total_Cost_USD "
    "FROM silver GROUP BY Device_ID, Date, Hour_of_Day, Operational_Shift",
    "fact_fault_events": "SELECT timestamp_formatted, Device_ID, Active_Fault_Code, Setpoint_Deviation, "
    "SLA_Breach_Flag FROM silver WHERE Active_Fault_Code != '0' OR SLA_Breach_Flag = 1",
    "mart_daily_costs": "SELECT Date, Device_ID, "
    f"{round2('SUM(Estimated_Hourly_Cost_USD)')} AS Daily_Cost_USD, "
    f"{round2('SUM(System_Power_Consumption_kW)')} AS Daily_Power_kW "
    "FROM silver GROUP BY Date, Device_ID",
    "mart_shift_performance": "SELECT Date, Operational_Shift, "
    f"{round2('AVG(Cooling_Capacity_Delta)')} AS Avg_Cooling_Capacity, "
    f"{round2('AVG(System_Load_Percentage)')} AS Avg_System_Load "
    "FROM silver GROUP BY Date, Operational_Shift",
    "mart_sla_breach_summary": "SELECT Device_ID, Date, "
    f"{_sum_int('SLA_Breach_Flag')} AS Total_Breaches, "
    f"{round2('MAX(Setpoint_Deviation)')} AS Max_Deviation "
    "FROM silver GROUP BY Device_ID, Date",
    "mart_compressor_health": "SELECT Device_ID, Date, "
    f"{round2('AVG(Total_Compressor_Amps)')} AS Avg_Amps, "
    f"{round2('MAX(Total_Compressor_Amps)')} AS Max_Amps, "
    f"{round2('AVG(VFD_Frequency_Hz)')} AS Avg_VFD_Hz "
    "FROM silver GROUP BY Device_ID, Date",
    "mart_environmental_compliance": "SELECT Date, Operational_Shift, "
    f"{round2('AVG(CO2_Level_PPM)')} AS Avg_CO2, "
    f"{_POOR} AS Poor_Air_Quality_Events "
    "FROM silver GROUP BY Date, Operational_Shift",
    "mart_pump_maintenance": "SELECT Device_ID, MAX(Pump_Hours) AS Total_Run_Hours, "
    f"{_RELAY_OFF} AS Pump_Failures "
    "FROM silver GROUP BY Device_ID",
    "mart_cooling_efficiency": "SELECT Device_ID, Date, "
    f"{round2('AVG(Energy_Efficiency_Ratio_EER)')} AS Avg_EER, "
    f"{round2('AVG(Evaporator_Approach_Temp)')} AS Avg_Evap_Approach, "
    f"{round2('AVG(Condenser_Approach_Temp)')} AS Avg_Cond_Approach "
    "FROM silver GROUP BY Device_ID, Date",
    "mart_valve_operations": "SELECT Device_ID, "
    f"{round2('AVG(Chilled_Water_Valve_Position_Pct)')} AS Avg_Chilled_Valve_Pct, "
    f"{round2('AVG(Condenser_Water_Valve_Position_Pct)')} AS Avg_Condenser_Valve_Pct "
    "FROM silver GROUP BY Device_ID",
    "mart_filter_diagnostics": "SELECT Device_ID, Date, "
    f"{round2('MAX(Filter_Pressure_Drop_Pa)')} AS Max_Pressure_Drop, "
    f"{_REPLACE} AS Filter_Alerts "
    "FROM silver GROUP BY Device_ID, Date",
}


def with_layers(body: str, gold: tuple[str, ...] = (), upto: str = "silver") -> str:
    """Prefix ``body`` with the CTE chain it needs.

    ``upto`` is ``telemetry``, ``staging``, ``silver_typed`` or ``silver``;
    each name in ``gold`` adds a ``gold_<name>`` CTE over silver.
    """
    ctes = [f"telemetry AS (\n{telemetry_sql('events', 'duckdb')}\n)"]
    chain = ["staging", "silver_typed", "silver"]
    need = chain[: chain.index(upto) + 1] if upto in chain else []
    if gold:
        need = chain
    if "staging" in need:
        ctes.append(f"staging AS ({_staging()})")
    if "silver_typed" in need:
        ctes.append(f"silver_typed AS ({_cast_sensors('staging')})")
    if "silver" in need:
        ctes.append(f"silver AS ({_silver()})")
    for g in gold:
        ctes.append(f"gold_{g} AS ({GOLD_SQL[g]})")
    return "WITH " + ",\n".join(ctes) + "\n" + body


def with_live(body: str) -> str:
    return f"WITH live AS (\n{live_sql('events', 'duckdb')}\n)\n{body}"


def medallion_oracles() -> dict[str, str]:
    """Texts for the layer operators and the 15 gold tables."""
    crit = " AND ".join(f"{q(c)} IS NOT NULL" for c in CRITICAL_COLUMNS)
    out = {
        "drop_missing_critical": with_layers(f"SELECT * FROM telemetry WHERE {crit}", upto="telemetry"),
        "drop_exact_duplicates": with_layers("SELECT DISTINCT * FROM telemetry", upto="telemetry"),
        "staging": with_layers("SELECT * FROM staging", upto="staging"),
        "cast_sensors": with_layers("SELECT * FROM silver_typed", upto="silver_typed"),
        "silver": with_layers("SELECT * FROM silver"),
    }
    for name in GOLD_SQL:
        out[name] = with_layers(f"SELECT * FROM gold_{name}", gold=(name,))
    return out
