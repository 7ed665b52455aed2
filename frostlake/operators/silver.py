"""Silver layer: typed sensors and the derived operational columns.

One ``select`` produces all 57 columns (the 40 raw ones, 17 of them re-typed in
place, then ``Pump_Hours`` and 16 derived). It is a narrow, per-row projection:
no shuffle, and it runs unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostlake.functions.columns import (
    epoch_ms_to_seconds,
    rounder,
    seconds_to_timestamp,
    seconds_to_utc_wall_clock,
    to_double,
)
from frostlake.schema import RAW_FIELDS, SENSOR_DOUBLE_COLUMNS


@dataclass(frozen=True)
class SilverRules:
    """Thresholds of the derived columns.

    Fixed values: the defaults are the business rules of the telemetry model.
    Comparisons are strict (``>``); shifts are half-open hour ranges
    [morning_start, afternoon_start) and [afternoon_start, night_start).
    """

    sla_deviation_limit: float = 2.0
    cost_per_kw: float = 0.12
    vfd_full_speed_hz: float = 60.0
    co2_poor_above_ppm: float = 600.0
    filter_replace_above_pa: float = 120.0
    morning_start_hour: int = 6
    afternoon_start_hour: int = 14
    night_start_hour: int = 22
    healthy_fault_code: str = "0"
    time_zone: str = "UTC"
    rounding: str = "round2"


DEFAULT_RULES = SilverRules()


def cast_sensors(df: DataFrame) -> DataFrame:
    """Re-type the 17 sensor columns to double in place and add
    ``Pump_Hours`` (the pump-2 counter as a double; the source column stays)."""
    typed = set(SENSOR_DOUBLE_COLUMNS)
    cols = [to_double(c).alias(c) if c in typed else F.col(c) for c in df.columns]
    cols.append(to_double("Cumulated_Pump_2_Hours_Sensor").alias("Pump_Hours"))
    return df.select(*cols)


def reading_day_hour(rules: SilverRules = DEFAULT_RULES) -> tuple[Column, Column]:
    """The day and the hour of a reading (D2, D3), from staging's epoch text."""
    wall = seconds_to_utc_wall_clock(epoch_ms_to_seconds("timestamp"), rules.time_zone)
    return F.to_date(wall), F.hour(wall)


def derived_columns(rules: SilverRules = DEFAULT_RULES) -> list[Column]:
    """D1-D16 as expressions over the (already cast) sensor columns."""
    r = rounder(rules.rounding)
    c = F.col

    secs = epoch_ms_to_seconds("timestamp")
    day, hour = reading_day_hour(rules)
    deviation = r(c("Leaving_Chilled_Water_Temperature_Sensor") - c("Leaving_Chilled_Water_Temperature_Setpoint"))

    shift = (
        F.when((hour >= rules.morning_start_hour) & (hour < rules.afternoon_start_hour), "Morning")
        .when((hour >= rules.afternoon_start_hour) & (hour < rules.night_start_hour), "Afternoon")
        .otherwise("Night")
    )
    return [
        seconds_to_timestamp(secs).alias("timestamp_formatted"),  # D1
        day.alias("Date"),  # D2
        hour.alias("Hour_of_Day"),  # D3
        shift.alias("Operational_Shift"),  # D4
        r(c("Entering_Chilled_Water_Temperature_Sensor") - c("Leaving_Chilled_Water_Temperature_Sensor")).alias(
            "Cooling_Capacity_Delta"
        ),  # D5
        deviation.alias("Setpoint_Deviation"),  # D6
        F.when(deviation > F.lit(rules.sla_deviation_limit), 1).otherwise(0).alias("SLA_Breach_Flag"),  # D7
        r(c("System_Power_Consumption_kW") * F.lit(rules.cost_per_kw)).alias("Estimated_Hourly_Cost_USD"),  # D8
        r((c("VFD_Frequency_Hz") / F.lit(rules.vfd_full_speed_hz)) * F.lit(100)).alias("System_Load_Percentage"),  # D9
        r(c("Compressor_1_Current_Amps") + c("Compressor_2_Current_Amps")).alias("Total_Compressor_Amps"),  # D10
        F.when(c("CO2_Level_PPM") > F.lit(rules.co2_poor_above_ppm), "Poor").otherwise("Good").alias(
            "Air_Quality_Status"
        ),  # D11
        F.when(c("Filter_Pressure_Drop_Pa") > F.lit(rules.filter_replace_above_pa), "Replace Filter")
        .otherwise("None")
        .alias("Maintenance_Recommendation"),  # D12
        F.when(c("Active_Fault_Code") == F.lit(rules.healthy_fault_code), "Healthy")
        .otherwise("Critical")
        .alias("Asset_Health_Status"),  # D13
        r(c("Leaving_Chilled_Water_Temperature_Sensor") - c("Refrigerant_Suction_Temperature")).alias(
            "Evaporator_Approach_Temp"
        ),  # D14
        r(c("Refrigerant_Discharge_Temperature") - c("Cooling_Tower_Water_Temperature")).alias(
            "Condenser_Approach_Temp"
        ),  # D15
        r(c("Return_Air_Temperature_Sensor") - c("Supply_Air_Temperature_Sensor")).alias("Air_Cooling_Delta"),  # D16
    ]


def silver(df: DataFrame, rules: SilverRules = DEFAULT_RULES) -> DataFrame:
    """C1 + D1-D16 over the staging layer (57 columns)."""
    typed = cast_sensors(df.select(*RAW_FIELDS))
    return typed.select("*", *derived_columns(rules))
