"""Unit edges of staging and silver, on hand-made raw rows."""

from __future__ import annotations

import datetime as dt

from conftest import raw_df, raw_row

from frostlake.operators.silver import SilverRules, silver
from frostlake.operators.staging import drop_exact_duplicates, drop_missing_critical, staging
from frostlake.schema import SILVER_COLUMNS

HOUR_MS = 3600 * 1000
DAY0 = 1704067200000  # 2024-01-01 00:00:00 UTC


def one(spark, **kw):
    return silver(raw_df(spark, [raw_row(**kw)])).collect()[0]


def test_silver_has_57_columns_in_order(spark):
    df = silver(raw_df(spark, [raw_row()]))
    assert tuple(df.columns) == SILVER_COLUMNS
    assert len(df.columns) == 57
    types = dict(df.dtypes)
    assert types["timestamp_formatted"] == "timestamp"
    assert types["Date"] == "date"
    assert types["Hour_of_Day"] == "int"
    assert types["SLA_Breach_Flag"] == "int"
    assert types["Pump_Hours"] == "double"
    assert types["Cumulated_Pump_2_Hours_Sensor"] == "string"
    assert types["Pump_Relay_1_Status"] == "string"


def test_shift_edges(spark):
    rows = [raw_row(timestamp=str(DAY0 + h * HOUR_MS)) for h in (0, 5, 6, 13, 14, 21, 22, 23)]
    got = {r.Hour_of_Day: r.Operational_Shift for r in silver(raw_df(spark, rows)).collect()}
    assert got == {
        0: "Night",
        5: "Night",
        6: "Morning",
        13: "Morning",
        14: "Afternoon",
        21: "Afternoon",
        22: "Night",
        23: "Night",
    }


def test_timestamp_truncates_to_whole_seconds(spark):
    r = one(spark, timestamp=str(DAY0 + 1999))
    assert r.timestamp_formatted == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert r.Date == dt.date(2024, 1, 1)
    assert r.Hour_of_Day == 0


def test_malformed_timestamp_is_null_and_night(spark):
    for bad in ("xyz", "2024-01-01T10:00:00", "", "1e300"):
        r = one(spark, timestamp=bad)
        assert r.timestamp_formatted is None and r.Date is None and r.Hour_of_Day is None
        assert r.Operational_Shift == "Night"


def test_deviation_rounded_before_compare(spark):
    # 42.0 - 40.00001525878906 = 1.99998... -> rounds to 2.0 -> not a breach
    assert one(spark, Leaving_Chilled_Water_Temperature_Sensor="42.0").SLA_Breach_Flag == 0
    r = one(spark, Leaving_Chilled_Water_Temperature_Sensor="42.01")
    assert r.Setpoint_Deviation == 2.01 and r.SLA_Breach_Flag == 1
    assert one(spark, Leaving_Chilled_Water_Temperature_Sensor="42.005").Setpoint_Deviation == 2.0


def test_thresholds_are_strict(spark):
    assert one(spark, CO2_Level_PPM="600").Air_Quality_Status == "Good"
    assert one(spark, CO2_Level_PPM="601").Air_Quality_Status == "Poor"
    assert one(spark, Filter_Pressure_Drop_Pa="120").Maintenance_Recommendation == "None"
    assert one(spark, Filter_Pressure_Drop_Pa="120.1").Maintenance_Recommendation == "Replace Filter"


def test_nulls_go_to_otherwise(spark):
    r = one(spark, CO2_Level_PPM=None, Filter_Pressure_Drop_Pa=None, Leaving_Chilled_Water_Temperature_Setpoint=None)
    assert r.Air_Quality_Status == "Good"
    assert r.Maintenance_Recommendation == "None"  # the string, not null
    assert r.SLA_Breach_Flag == 0
    assert one(spark, Active_Fault_Code=None).Asset_Health_Status == "Critical"


def test_fault_code_is_text(spark):
    assert one(spark, Active_Fault_Code="007").Asset_Health_Status == "Critical"
    assert one(spark, Active_Fault_Code="0").Asset_Health_Status == "Healthy"


def test_malformed_numbers_become_null_not_errors(spark):
    r = one(spark, System_Power_Consumption_kW="n/a", Compressor_1_Current_Amps="12,5")
    assert r.System_Power_Consumption_kW is None
    assert r.Estimated_Hourly_Cost_USD is None
    assert r.Total_Compressor_Amps is None


def test_derived_arithmetic(spark):
    r = one(
        spark,
        System_Power_Consumption_kW="100.0",
        VFD_Frequency_Hz="45.0",
        Compressor_1_Current_Amps="50.25",
        Compressor_2_Current_Amps="60.5",
        Return_Air_Temperature_Sensor="75.0",
        Supply_Air_Temperature_Sensor="60.55",
    )
    assert r.Estimated_Hourly_Cost_USD == 12.0
    assert r.System_Load_Percentage == 75.0
    assert r.Total_Compressor_Amps == 110.75
    assert r.Air_Cooling_Delta == 14.45
    assert r.Cooling_Capacity_Delta == 29.0


def test_round2_is_half_up_on_decimal_value(spark):
    # 1.005 is stored as 1.00499999999999989..., native round gives 1.0
    from pyspark.sql import functions as F

    from frostlake.functions import round2, round_native

    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (float("nan"),), (None,), (1e15 + 0.125,)], "x double")
    got = df.select(round2("x").alias("a"), round_native("x").alias("b")).collect()
    assert [g.a for g in got[:3]] == [1.01, 2.68, -1.01]
    assert got[3].a != got[3].a  # NaN stays NaN
    assert got[4].a is None
    assert got[5].a == df.select(F.round("x", 2)).collect()[5][0]


def test_rules_are_parameters(spark):
    rules = SilverRules(co2_poor_above_ppm=400, rounding="native")
    r = silver(raw_df(spark, [raw_row(CO2_Level_PPM="450")]), rules).collect()[0]
    assert r.Air_Quality_Status == "Poor"


def test_drop_missing_critical_any(spark):
    rows = [
        raw_row(),
        raw_row(Device_ID=None),
        raw_row(Entering_Chilled_Water_Temperature_Sensor=None),
        raw_row(Leaving_Chilled_Water_Temperature_Sensor=None),
        raw_row(CO2_Level_PPM=None),
    ]
    assert drop_missing_critical(raw_df(spark, rows)).count() == 2


def test_dedupe_on_text_before_cast(spark):
    rows = [raw_row(), raw_row(), raw_row(Entering_Chilled_Water_Temperature_Sensor="70.00")]
    assert drop_exact_duplicates(raw_df(spark, rows)).count() == 2
    assert staging(raw_df(spark, rows)).count() == 2


def test_empty_input(spark):
    df = silver(staging(raw_df(spark, [])))
    assert df.count() == 0 and len(df.columns) == 57


def test_drop_missing_critical_equals_dropna(spark):
    rows = [raw_row(), raw_row(Device_ID=None), raw_row(Leaving_Chilled_Water_Temperature_Sensor=None)]
    df = raw_df(spark, rows)
    from frostlake.schema import CRITICAL_COLUMNS

    assert sorted(drop_missing_critical(df).collect()) == sorted(df.dropna(subset=list(CRITICAL_COLUMNS)).collect())
