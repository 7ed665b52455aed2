"""Record shapes of the telemetry lake.

Fixed values: the raw field names (and their order), the live field names and
the silver column order must equal the shapes the pipeline was designed
around, so they are written out plainly here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 40 raw fields, all strings, in their natural order.
RAW_FIELDS: tuple[str, ...] = (
    "timestamp",
    "Device_ID",
    "Entering_Chilled_Water_Temperature_Sensor",
    "Leaving_Chilled_Water_Temperature_Sensor",
    "Cumulated_Pump_2_Hours_Sensor",
    "Cooler_Fluid_Type_Select_Status",
    "Pump_Relay_1_Status",
    "Pump_Relay_2_Status",
    "Flow_Switch_Status",
    "Leaving_Chilled_Water_Temperature_Setpoint",
    "LWT_Setpoint",
    "Pump_Control_Parameter",
    "Compressor_1_Status",
    "Compressor_2_Status",
    "Evaporator_Pressure_Sensor_kPa",
    "Condenser_Pressure_Sensor_kPa",
    "Refrigerant_Discharge_Temperature",
    "Refrigerant_Suction_Temperature",
    "Oil_Pressure_Sensor_kPa",
    "Oil_Temperature_Sensor",
    "Ambient_Air_Temperature_Sensor",
    "Return_Air_Temperature_Sensor",
    "Supply_Air_Temperature_Sensor",
    "Relative_Humidity_Percentage",
    "CO2_Level_PPM",
    "Filter_Pressure_Drop_Pa",
    "System_Power_Consumption_kW",
    "Compressor_1_Current_Amps",
    "Compressor_2_Current_Amps",
    "VFD_Frequency_Hz",
    "Energy_Efficiency_Ratio_EER",
    "Pump_Shutdhow_Daily_Setpoint",
    "Evaporator_Water_Flow_Rate_GPM",
    "Condenser_Water_Flow_Rate_GPM",
    "Cooling_Tower_Water_Temperature",
    "Chilled_Water_Valve_Position_Pct",
    "Condenser_Water_Valve_Position_Pct",
    "Chiller_Run_Hours",
    "Active_Fault_Code",
    "Maintenance_Required_Flag",
)

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

# Columns that silver re-types to double in place.
SENSOR_DOUBLE_COLUMNS: tuple[str, ...] = (
    "Entering_Chilled_Water_Temperature_Sensor",
    "Leaving_Chilled_Water_Temperature_Sensor",
    "Leaving_Chilled_Water_Temperature_Setpoint",
    "System_Power_Consumption_kW",
    "VFD_Frequency_Hz",
    "Compressor_1_Current_Amps",
    "Compressor_2_Current_Amps",
    "CO2_Level_PPM",
    "Filter_Pressure_Drop_Pa",
    "Refrigerant_Suction_Temperature",
    "Refrigerant_Discharge_Temperature",
    "Cooling_Tower_Water_Temperature",
    "Return_Air_Temperature_Sensor",
    "Supply_Air_Temperature_Sensor",
    "Energy_Efficiency_Ratio_EER",
    "Chilled_Water_Valve_Position_Pct",
    "Condenser_Water_Valve_Position_Pct",
)

# The columns a reading cannot be used without.
CRITICAL_COLUMNS: tuple[str, ...] = (
    "Device_ID",
    "Entering_Chilled_Water_Temperature_Sensor",
    "Leaving_Chilled_Water_Temperature_Sensor",
)

# The 17 columns silver appends after the 40 raw ones.
SILVER_EXTRA_COLUMNS: tuple[str, ...] = (
    "Pump_Hours",
    "timestamp_formatted",
    "Date",
    "Hour_of_Day",
    "Operational_Shift",
    "Cooling_Capacity_Delta",
    "Setpoint_Deviation",
    "SLA_Breach_Flag",
    "Estimated_Hourly_Cost_USD",
    "System_Load_Percentage",
    "Total_Compressor_Amps",
    "Air_Quality_Status",
    "Maintenance_Recommendation",
    "Asset_Health_Status",
    "Evaporator_Approach_Temp",
    "Condenser_Approach_Temp",
    "Air_Cooling_Delta",
)

SILVER_COLUMNS: tuple[str, ...] = RAW_FIELDS + SILVER_EXTRA_COLUMNS

# The live (streamed) reading, typed JSON.
LIVE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("Device_ID", T.StringType(), True),
        T.StructField("Entering_Chilled_Water_Temperature_Sensor", T.DoubleType(), True),
        T.StructField("Leaving_Chilled_Water_Temperature_Sensor", T.DoubleType(), True),
        T.StructField("Condenser_Water_Flow_Rate_Sensor_GPM", T.DoubleType(), True),
        T.StructField("System_Power_Consumption_kW", T.DoubleType(), True),
        T.StructField("Active_Fault_Code", T.StringType(), True),
        T.StructField("Pump_Hours", T.LongType(), True),
        T.StructField("CO2_Level_PPM", T.LongType(), True),
    ]
)

LIVE_FIELDS: tuple[str, ...] = tuple(f.name for f in LIVE_SCHEMA.fields)

# Arrival order of a live message (Kafka offset, or an explicit column for
# file-fed streams).
SEQ_COLUMN = "seq"
