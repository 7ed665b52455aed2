"""Gold layer: 4 dimensions, 2 facts and 9 marts over silver.

Two execution forms give the same tables:

* ``direct`` - one aggregate per table (15 scans of silver, 14 shuffles); best
  when a single table is wanted, since Catalyst prunes the scan to the 3-8
  columns the table uses.
* ``shared`` - what a full run uses. Every mart's grouping key is a coarsening
  of (Device_ID, Date, Hour_of_Day, Operational_Shift), so silver is
  aggregated once at that grain into additive partial states (sum, count,
  max), and each mart rolls those up. The three dimensions not on that grain
  come from one GROUPING SETS pass. Silver is scanned twice instead of 15
  times and every shuffle carries pre-aggregated rows only.

Averages are ``sum / count`` of non-null values, exactly what AVG computes.
Aggregates are map-side combined (partial + final hash aggregate), so a device
holding a third of all readings costs one partial row per input split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostlake.functions.columns import rounder

HOURLY_KEYS = ["Device_ID", "Date", "Hour_of_Day", "Operational_Shift"]
DEVICE_DAY_KEYS = ["Device_ID", "Date"]
DAY_DEVICE_KEYS = ["Date", "Device_ID"]
DAY_SHIFT_KEYS = ["Date", "Operational_Shift"]
DEVICE_KEYS = ["Device_ID"]

# The columns of each dimension table.
DIM_DEVICE_COLUMNS = [
    "Device_ID",
    "Cooler_Fluid_Type_Select_Status",
    "Pump_Control_Parameter",
    "Pump_Shutdhow_Daily_Setpoint",
]
DIM_TIME_COLUMNS = ["Date", "Hour_of_Day", "Operational_Shift"]
DIM_FAULT_COLUMNS = ["Active_Fault_Code", "Asset_Health_Status"]
DIM_STATUS_COLUMNS = ["Air_Quality_Status", "Maintenance_Recommendation"]

FACT_FAULT_COLUMNS = [
    "timestamp_formatted",
    "Device_ID",
    "Active_Fault_Code",
    "Setpoint_Deviation",
    "SLA_Breach_Flag",
]

GOLD_TABLES = (
    "dim_device",
    "dim_time",
    "dim_fault_codes",
    "dim_status_flags",
    "fact_hourly_telemetry",
    "fact_fault_events",
    "mart_daily_costs",
    "mart_shift_performance",
    "mart_sla_breach_summary",
    "mart_compressor_health",
    "mart_environmental_compliance",
    "mart_pump_maintenance",
    "mart_cooling_efficiency",
    "mart_valve_operations",
    "mart_filter_diagnostics",
)


def _count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) - a bigint, never null."""
    return F.sum(F.when(cond, 1).otherwise(0))


# ---------------------------------------------------------------- direct form


def dim_device(silver: DataFrame) -> DataFrame:
    """G1. Not one row per device: a device appears once per attribute combination."""
    return silver.select(*DIM_DEVICE_COLUMNS).distinct()


def dim_time(silver: DataFrame) -> DataFrame:
    """G2."""
    return silver.select(*DIM_TIME_COLUMNS).distinct()


def dim_fault_codes(silver: DataFrame) -> DataFrame:
    """G3."""
    return silver.select(*DIM_FAULT_COLUMNS).distinct()


def dim_status_flags(silver: DataFrame) -> DataFrame:
    """G4."""
    return silver.select(*DIM_STATUS_COLUMNS).distinct()


def fact_hourly_telemetry(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G5."""
    r = rounder(rounding)
    return silver.groupBy(*HOURLY_KEYS).agg(
        r(F.avg("Entering_Chilled_Water_Temperature_Sensor")).alias("Avg_Entering_Temp"),
        r(F.avg("Leaving_Chilled_Water_Temperature_Sensor")).alias("Avg_Leaving_Temp"),
        r(F.avg("System_Power_Consumption_kW")).alias("Avg_Power_kW"),
        r(F.sum("Estimated_Hourly_Cost_USD")).alias("Total_Cost_USD"),
    )


def fact_fault_events(silver: DataFrame, healthy_code: str = "0", extra: Sequence[str] = ()) -> DataFrame:
    """Readings with a fault or an SLA breach; no grouping, no shuffle.
    ``extra`` columns of silver follow the table's own."""
    cond = (F.col("Active_Fault_Code") != F.lit(healthy_code)) | (F.col("SLA_Breach_Flag") == 1)
    return silver.where(cond).select(*FACT_FAULT_COLUMNS, *extra)


def mart_daily_costs(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G7."""
    r = rounder(rounding)
    return silver.groupBy(*DAY_DEVICE_KEYS).agg(
        r(F.sum("Estimated_Hourly_Cost_USD")).alias("Daily_Cost_USD"),
        r(F.sum("System_Power_Consumption_kW")).alias("Daily_Power_kW"),
    )


def mart_shift_performance(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G8."""
    r = rounder(rounding)
    return silver.groupBy(*DAY_SHIFT_KEYS).agg(
        r(F.avg("Cooling_Capacity_Delta")).alias("Avg_Cooling_Capacity"),
        r(F.avg("System_Load_Percentage")).alias("Avg_System_Load"),
    )


def mart_sla_breach_summary(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G9."""
    r = rounder(rounding)
    return silver.groupBy(*DEVICE_DAY_KEYS).agg(
        F.sum("SLA_Breach_Flag").alias("Total_Breaches"),
        r(F.max("Setpoint_Deviation")).alias("Max_Deviation"),
    )


def mart_compressor_health(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G10."""
    r = rounder(rounding)
    return silver.groupBy(*DEVICE_DAY_KEYS).agg(
        r(F.avg("Total_Compressor_Amps")).alias("Avg_Amps"),
        r(F.max("Total_Compressor_Amps")).alias("Max_Amps"),
        r(F.avg("VFD_Frequency_Hz")).alias("Avg_VFD_Hz"),
    )


def mart_environmental_compliance(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G11."""
    r = rounder(rounding)
    return silver.groupBy(*DAY_SHIFT_KEYS).agg(
        r(F.avg("CO2_Level_PPM")).alias("Avg_CO2"),
        _count_when(F.col("Air_Quality_Status") == "Poor").alias("Poor_Air_Quality_Events"),
    )


def mart_pump_maintenance(silver: DataFrame) -> DataFrame:
    """G12. ``Total_Run_Hours`` is not rounded; relay status is compared as text."""
    return silver.groupBy(*DEVICE_KEYS).agg(
        F.max("Pump_Hours").alias("Total_Run_Hours"),
        _count_when(F.col("Pump_Relay_1_Status") == "0").alias("Pump_Failures"),
    )


def mart_cooling_efficiency(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G13."""
    r = rounder(rounding)
    return silver.groupBy(*DEVICE_DAY_KEYS).agg(
        r(F.avg("Energy_Efficiency_Ratio_EER")).alias("Avg_EER"),
        r(F.avg("Evaporator_Approach_Temp")).alias("Avg_Evap_Approach"),
        r(F.avg("Condenser_Approach_Temp")).alias("Avg_Cond_Approach"),
    )


def mart_valve_operations(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G14."""
    r = rounder(rounding)
    return silver.groupBy(*DEVICE_KEYS).agg(
        r(F.avg("Chilled_Water_Valve_Position_Pct")).alias("Avg_Chilled_Valve_Pct"),
        r(F.avg("Condenser_Water_Valve_Position_Pct")).alias("Avg_Condenser_Valve_Pct"),
    )


def mart_filter_diagnostics(silver: DataFrame, rounding: str = "round2") -> DataFrame:
    """G15."""
    r = rounder(rounding)
    return silver.groupBy(*DEVICE_DAY_KEYS).agg(
        r(F.max("Filter_Pressure_Drop_Pa")).alias("Max_Pressure_Drop"),
        _count_when(F.col("Maintenance_Recommendation") == "Replace Filter").alias("Filter_Alerts"),
    )


DIRECT: dict[str, Callable[..., DataFrame]] = {
    "dim_device": dim_device,
    "dim_time": dim_time,
    "dim_fault_codes": dim_fault_codes,
    "dim_status_flags": dim_status_flags,
    "fact_hourly_telemetry": fact_hourly_telemetry,
    "fact_fault_events": fact_fault_events,
    "mart_daily_costs": mart_daily_costs,
    "mart_shift_performance": mart_shift_performance,
    "mart_sla_breach_summary": mart_sla_breach_summary,
    "mart_compressor_health": mart_compressor_health,
    "mart_environmental_compliance": mart_environmental_compliance,
    "mart_pump_maintenance": mart_pump_maintenance,
    "mart_cooling_efficiency": mart_cooling_efficiency,
    "mart_valve_operations": mart_valve_operations,
    "mart_filter_diagnostics": mart_filter_diagnostics,
}

_ROUNDED = {k for k in DIRECT if k.startswith(("fact_hourly", "mart_")) and k != "mart_pump_maintenance"}


def gold_table(silver: DataFrame, name: str, rounding: str = "round2") -> DataFrame:
    """One gold table in the direct form."""
    fn = DIRECT[name]
    return fn(silver, rounding=rounding) if name in _ROUNDED else fn(silver)


# ---------------------------------------------------------------- shared form

# Measures kept at the hourly grain: (column, partial states wanted).
_SUM_COUNT = [
    "Entering_Chilled_Water_Temperature_Sensor",
    "Leaving_Chilled_Water_Temperature_Sensor",
    "System_Power_Consumption_kW",
    "Cooling_Capacity_Delta",
    "System_Load_Percentage",
    "Total_Compressor_Amps",
    "VFD_Frequency_Hz",
    "CO2_Level_PPM",
    "Energy_Efficiency_Ratio_EER",
    "Evaporator_Approach_Temp",
    "Condenser_Approach_Temp",
    "Chilled_Water_Valve_Position_Pct",
    "Condenser_Water_Valve_Position_Pct",
]
_SUM_ONLY = ["Estimated_Hourly_Cost_USD", "SLA_Breach_Flag"]
_MAX = ["Setpoint_Deviation", "Total_Compressor_Amps", "Pump_Hours", "Filter_Pressure_Drop_Pa"]
# Conditional counts as (name, column, value that is counted).
_FLAG_COUNTS = (
    ("n_poor_air", "Air_Quality_Status", "Poor"),
    ("n_relay1_off", "Pump_Relay_1_Status", "0"),
    ("n_replace_filter", "Maintenance_Recommendation", "Replace Filter"),
)


def _s(c: str) -> str:
    return f"s__{c}"


def _n(c: str) -> str:
    return f"n__{c}"


def _m(c: str) -> str:
    return f"m__{c}"


def hourly_partials(silver: DataFrame) -> DataFrame:
    """Additive partial states of every gold measure at the hourly grain."""
    aggs: list[Column] = []
    for c in _SUM_COUNT:
        aggs += [F.sum(c).alias(_s(c)), F.count(c).alias(_n(c))]
    for c in _SUM_ONLY:
        if c not in _SUM_COUNT:
            aggs.append(F.sum(c).alias(_s(c)))
    aggs += [F.max(c).alias(_m(c)) for c in _MAX]
    aggs += [_count_when(F.col(c) == F.lit(v)).alias(name) for name, c, v in _FLAG_COUNTS]
    return silver.groupBy(*HOURLY_KEYS).agg(*aggs)


def _avg(c: str) -> Column:
    return F.try_divide(F.sum(_s(c)), F.sum(_n(c)))


def _avg_here(c: str) -> Column:
    return F.try_divide(F.col(_s(c)), F.col(_n(c)))


def gold_from_partials(partials: DataFrame, rounding: str = "round2") -> dict[str, DataFrame]:
    """The 11 fact/mart tables (and ``dim_time``) rolled up from the partials."""
    r = rounder(rounding)
    p = partials
    device_day = p.groupBy(*DEVICE_DAY_KEYS)
    day_shift = p.groupBy(*DAY_SHIFT_KEYS)
    device = p.groupBy(*DEVICE_KEYS)
    ent, lea, kw = (
        "Entering_Chilled_Water_Temperature_Sensor",
        "Leaving_Chilled_Water_Temperature_Sensor",
        "System_Power_Consumption_kW",
    )
    return {
        "dim_time": p.select(*DIM_TIME_COLUMNS).distinct(),
        "fact_hourly_telemetry": p.select(
            *HOURLY_KEYS,
            r(_avg_here(ent)).alias("Avg_Entering_Temp"),
            r(_avg_here(lea)).alias("Avg_Leaving_Temp"),
            r(_avg_here(kw)).alias("Avg_Power_kW"),
            r(F.col(_s("Estimated_Hourly_Cost_USD"))).alias("Total_Cost_USD"),
        ),
        "mart_daily_costs": p.groupBy(*DAY_DEVICE_KEYS).agg(
            r(F.sum(_s("Estimated_Hourly_Cost_USD"))).alias("Daily_Cost_USD"),
            r(F.sum(_s(kw))).alias("Daily_Power_kW"),
        ),
        "mart_shift_performance": day_shift.agg(
            r(_avg("Cooling_Capacity_Delta")).alias("Avg_Cooling_Capacity"),
            r(_avg("System_Load_Percentage")).alias("Avg_System_Load"),
        ),
        "mart_sla_breach_summary": device_day.agg(
            F.sum(_s("SLA_Breach_Flag")).alias("Total_Breaches"),
            r(F.max(_m("Setpoint_Deviation"))).alias("Max_Deviation"),
        ),
        "mart_compressor_health": device_day.agg(
            r(_avg("Total_Compressor_Amps")).alias("Avg_Amps"),
            r(F.max(_m("Total_Compressor_Amps"))).alias("Max_Amps"),
            r(_avg("VFD_Frequency_Hz")).alias("Avg_VFD_Hz"),
        ),
        "mart_environmental_compliance": day_shift.agg(
            r(_avg("CO2_Level_PPM")).alias("Avg_CO2"),
            F.sum("n_poor_air").alias("Poor_Air_Quality_Events"),
        ),
        "mart_pump_maintenance": device.agg(
            F.max(_m("Pump_Hours")).alias("Total_Run_Hours"),
            F.sum("n_relay1_off").alias("Pump_Failures"),
        ),
        "mart_cooling_efficiency": device_day.agg(
            r(_avg("Energy_Efficiency_Ratio_EER")).alias("Avg_EER"),
            r(_avg("Evaporator_Approach_Temp")).alias("Avg_Evap_Approach"),
            r(_avg("Condenser_Approach_Temp")).alias("Avg_Cond_Approach"),
        ),
        "mart_valve_operations": device.agg(
            r(_avg("Chilled_Water_Valve_Position_Pct")).alias("Avg_Chilled_Valve_Pct"),
            r(_avg("Condenser_Water_Valve_Position_Pct")).alias("Avg_Condenser_Valve_Pct"),
        ),
        "mart_filter_diagnostics": device_day.agg(
            r(F.max(_m("Filter_Pressure_Drop_Pa"))).alias("Max_Pressure_Drop"),
            F.sum("n_replace_filter").alias("Filter_Alerts"),
        ),
    }


DIM_SETS = {
    "dim_device": DIM_DEVICE_COLUMNS,
    "dim_fault_codes": DIM_FAULT_COLUMNS,
    "dim_status_flags": DIM_STATUS_COLUMNS,
}


def dimension_sets(silver: DataFrame) -> DataFrame:
    """The three off-grain dimensions in one GROUPING SETS aggregate.

    ``gid`` tells the sets apart, so a genuine null key (a null fault code) is
    not confused with a column left out of the set.
    """
    all_cols = [c for cols in DIM_SETS.values() for c in cols]
    sets = [[F.col(c) for c in cols] for cols in DIM_SETS.values()]
    return silver.groupingSets(sets, *all_cols).agg(F.grouping_id().alias("gid"))


def dims_from_sets(dims: DataFrame) -> dict[str, DataFrame]:
    all_cols = [c for cols in DIM_SETS.values() for c in cols]
    out = {}
    for name, cols in DIM_SETS.items():
        # grouping_id bit i (from the left, most significant first) is 1 when
        # column i is aggregated away; the set's own columns must be 0.
        gid = sum(1 << (len(all_cols) - 1 - i) for i, c in enumerate(all_cols) if c not in cols)
        out[name] = dims.where(F.col("gid") == gid).select(*cols)
    return out


def gold_tables(silver: DataFrame, form: str = "shared", rounding: str = "round2") -> dict[str, DataFrame]:
    """All 15 gold tables, keyed by name, in either execution form.

    In the shared form the caller should materialize ``hourly_partials`` and
    ``dimension_sets`` once (``plans.medallion`` does) - here they are plain
    lazy DataFrames.
    """
    if form == "direct":
        return {name: gold_table(silver, name, rounding) for name in GOLD_TABLES}
    if form != "shared":
        raise ValueError(f"unknown form {form!r}; use 'shared' or 'direct'")
    tables = gold_from_partials(hourly_partials(silver), rounding)
    tables.update(dims_from_sets(dimension_sets(silver)))
    tables["fact_fault_events"] = fact_fault_events(silver)
    return {name: tables[name] for name in GOLD_TABLES}
