"""Deterministic telemetry derived from the driver's ``events`` table.

The raw layer of every oracle test is the ``telemetry`` view: one 40-field
text reading per event, plus an exact copy of every event whose id ends in 07
(so staging has duplicates to remove). The ``live`` view is the typed 9-field
stream record plus an arrival column ``seq``. Both are pure expressions over
``events`` - Spark derives them, so their size grows with the table.

The same expressions are rendered as text for Spark SQL and for DuckDB (the
oracle), from one specification, so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.schema import RAW_FIELDS, SEQ_COLUMN
from frostlake.session import path_size_bytes

#: Bytes of a reading's JSON to one of its event in Parquet, and of the readings that one task makes.
WIDENED, TASK_BYTES = 72, 64 * 1024 * 1024

# Sensor text columns as (name, base, multiplier, modulus,
# divisor); value = (base + (event_id*multiplier + user_id) % modulus) / divisor,
# rendered as text. A divisor of 1 means an integer rendered without decimals.
NUMERIC_SENSORS: tuple[tuple[str, int, int, int, int], ...] = (
    ("Evaporator_Pressure_Sensor_kPa", 30000, 7001, 5001, 100),
    ("Condenser_Pressure_Sensor_kPa", 80000, 7013, 40001, 100),
    ("Refrigerant_Discharge_Temperature", 650, 7019, 201, 10),
    ("Refrigerant_Suction_Temperature", 50, 7027, 101, 10),
    ("Oil_Pressure_Sensor_kPa", 20000, 7039, 5001, 100),
    ("Oil_Temperature_Sensor", 400, 7043, 201, 10),
    ("Ambient_Air_Temperature_Sensor", 700, 7057, 251, 10),
    ("Return_Air_Temperature_Sensor", 680, 7069, 101, 10),
    ("Supply_Air_Temperature_Sensor", 550, 7079, 101, 10),
    ("Relative_Humidity_Percentage", 400, 7103, 201, 10),
    ("CO2_Level_PPM", 400, 7109, 401, 1),
    ("Filter_Pressure_Drop_Pa", 500, 7121, 1001, 10),
    ("System_Power_Consumption_kW", 5000, 7127, 10001, 100),
    ("Compressor_1_Current_Amps", 400, 7129, 401, 10),
    ("Compressor_2_Current_Amps", 400, 7151, 401, 10),
    ("VFD_Frequency_Hz", 300, 7159, 301, 10),
    ("Energy_Efficiency_Ratio_EER", 1000, 7177, 501, 100),
    ("Evaporator_Water_Flow_Rate_GPM", 2000, 7187, 1001, 10),
    ("Condenser_Water_Flow_Rate_GPM", 2500, 7193, 1001, 10),
    ("Cooling_Tower_Water_Temperature", 750, 7207, 101, 10),
    ("Chilled_Water_Valve_Position_Pct", 0, 7211, 1001, 10),
    ("Condenser_Water_Valve_Position_Pct", 0, 7213, 1001, 10),
)

# Small integer status columns as (name, offset, multiplier,
# modulus); value = offset + (event_id*multiplier + user_id) % modulus, as text.
STATUS_COLUMNS: tuple[tuple[str, int, int, int], ...] = (
    ("Cooler_Fluid_Type_Select_Status", 1, 3, 2),
    ("Pump_Relay_1_Status", 0, 5, 2),
    ("Pump_Relay_2_Status", 0, 11, 2),
    ("Flow_Switch_Status", 0, 13, 2),
    ("LWT_Setpoint", 0, 17, 6),
    ("Pump_Control_Parameter", 1, 19, 3),
    ("Compressor_1_Status", 0, 23, 2),
    ("Compressor_2_Status", 0, 29, 2),
    ("Pump_Shutdhow_Daily_Setpoint", 4, 31, 5),
)

# Every event whose id has this remainder mod 100 appears twice.
DUPLICATE_MOD = 100
DUPLICATE_REMAINDER = 7


def _q(name: str, dialect: str) -> str:
    return f"`{name}`" if dialect == "spark" else f'"{name}"'


def telemetry_select_list(dialect: str = "spark") -> list[str]:
    """The 40 raw-field expressions over ``events`` as SQL text, in field order."""
    num = "CAST(CAST({b}+((event_id*{m}+user_id) % {mod}) AS DOUBLE)/{d} AS STRING)"
    by_name: dict[str, str] = {}
    if dialect == "spark":
        # epoch milliseconds of the NTZ wall clock read as UTC, independent of
        # the session time zone (equal to unix_millis under a UTC session)
        by_name["timestamp"] = (
            "CAST(timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)"
        )
    else:
        # floor to whole milliseconds, as unix_millis does (epoch_ms rounds)
        by_name["timestamp"] = "CAST(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS STRING)"
    dev_no = "(1+user_id%15)"
    by_name["Device_ID"] = (
        f"concat('CHILLER_', CASE WHEN {dev_no}<10 THEN '0' ELSE '' END, CAST({dev_no} AS STRING))"
    )
    by_name["Entering_Chilled_Water_Temperature_Sensor"] = (
        "CASE WHEN event_id%25 < 2 THEN NULL ELSE "
        + num.format(b=600, m=7219, mod=166, d=10)
        + " END"
    )
    by_name["Leaving_Chilled_Water_Temperature_Sensor"] = (
        "CASE WHEN event_id%50 IN (4,5,6) THEN NULL ELSE "
        + num.format(b=360, m=7229, mod=81, d=10)
        + " END"
    )
    by_name["Cumulated_Pump_2_Hours_Sensor"] = "CAST(CAST(291120+event_id*5 AS DOUBLE)/10 AS STRING)"
    by_name["Leaving_Chilled_Water_Temperature_Setpoint"] = "'40.00001525878906'"
    for name, off, mult, mod in STATUS_COLUMNS:
        by_name[name] = f"CAST({off}+((event_id*{mult}+user_id) % {mod}) AS STRING)"
    for name, base, mult, mod, div in NUMERIC_SENSORS:
        if div == 1:
            by_name[name] = f"CAST({base}+((event_id*{mult}+user_id) % {mod}) AS STRING)"
        else:
            by_name[name] = num.format(b=base, m=mult, mod=mod, d=div)
    by_name["Chiller_Run_Hours"] = "CAST(CAST(150000+event_id AS DOUBLE)/10 AS STRING)"
    by_name["Active_Fault_Code"] = (
        "CASE WHEN event_type='error' AND event_id%4=0 THEN CAST(1+(event_id%99) AS STRING) ELSE '0' END"
    )
    by_name["Maintenance_Required_Flag"] = "'0'"
    return [f"{by_name[f]} AS {_q(f, dialect)}" for f in RAW_FIELDS]


def telemetry_sql(events: str = "events", dialect: str = "spark") -> str:
    """``SELECT`` text of the telemetry view over the table named ``events``."""
    sel = ",\n  ".join(telemetry_select_list(dialect))
    one = f"SELECT\n  {sel}\nFROM {events}"
    return f"{one}\nUNION ALL\n{one}\nWHERE event_id%{DUPLICATE_MOD} = {DUPLICATE_REMAINDER}"


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """The raw telemetry layer (40 text columns) derived from ``events``."""
    exprs = telemetry_select_list("spark")
    base = events.select("event_id", "ts", "user_id", "event_type")
    once = base.selectExpr(*exprs)
    dupes = base.where(F.col("event_id") % DUPLICATE_MOD == DUPLICATE_REMAINDER).selectExpr(*exprs)
    return once.unionByName(dupes)


def live_select_list(dialect: str = "spark") -> list[str]:
    """The live record (``seq`` + 9 typed fields) over ``events`` as SQL text."""
    if dialect == "spark":
        ts = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    else:
        ts = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
    dev_no = "(1+user_id%15)"
    exprs = [
        ("seq", "event_id"),
        ("timestamp", ts),
        ("Device_ID", f"concat('CHILLER_', CASE WHEN {dev_no}<10 THEN '0' ELSE '' END, CAST({dev_no} AS STRING))"),
        (
            "Entering_Chilled_Water_Temperature_Sensor",
            "CASE WHEN event_id%25 < 2 THEN NULL ELSE CAST(600+((event_id*7219+user_id)%166) AS DOUBLE)/10 END",
        ),
        ("Leaving_Chilled_Water_Temperature_Sensor", "CAST(360+((event_id*7229+user_id)%81) AS DOUBLE)/10"),
        ("Condenser_Water_Flow_Rate_Sensor_GPM", "CAST(2500+((event_id*7193+user_id)%1001) AS DOUBLE)/10"),
        ("System_Power_Consumption_kW", "CAST(5000+((event_id*7127+user_id)%10001) AS DOUBLE)/100"),
        (
            "Active_Fault_Code",
            "CASE WHEN event_type='error' THEN concat('F0', CAST(1+event_id%4 AS STRING)) ELSE '0' END",
        ),
        ("Pump_Hours", "CAST(1000+event_id AS BIGINT)"),
        ("CO2_Level_PPM", "CAST(400+((event_id*7109+user_id)%401) AS BIGINT)"),
    ]
    return [f"{e} AS {_q(n, dialect)}" for n, e in exprs]


def live_sql(events: str = "events", dialect: str = "spark") -> str:
    sel = ",\n  ".join(live_select_list(dialect))
    return f"SELECT\n  {sel}\nFROM {events}"


def live_from_events(events: DataFrame) -> DataFrame:
    """Typed live records with their arrival order ``seq``."""
    return events.selectExpr(*live_select_list("spark"))


#: Kinds of message in the dirty topic, dealt by ``event_id``; the last four are no JSON object.
DIRTY_KINDS = 9
_DIRTY_VALUES = (
    """'{"seq":' || id || ',"Device_ID":"C' || dev || '","Pump_Hours":' || id || ',"CO2_Level_PPM":410}'""",
    """'{"seq":' || id || ',"Device_ID":"C' || dev || '","Pump_Hours":' || id || '.0,"CO2_Level_PPM":410}'""",
    """'{"seq":' || id || ',"Device_ID":"C' || dev || '","Pump_Hours":' || id || '.5,"CO2_Level_PPM":410}'""",
    """'{"seq":' || id || ',"Device_ID":"C' || dev || '","Pump_Hours":"' || id || '","CO2_Level_PPM":"410"}'""",
    """'{"seq":' || id || ',"Device_ID":"C' || dev || '","Pump_Hours":' || id || ',"CO2_Level_PPM":"n/a"}'""",
    """'[' || id || ',' || dev || ']'""",
    """'{"seq":' || id || ',"Device_ID":'""",
    "'   '",
    "'null'",
)


_DIRTY_KEYS = ("event_id AS seq", f"event_id % {DIRTY_KINDS} AS kind", "CAST(event_id AS STRING) AS id", "CAST(user_id AS STRING) AS dev")
_DIRTY_VALUE = "CASE kind " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(_DIRTY_VALUES)) + " END AS value"


def dirty_messages_sql(events: str = "events") -> str:
    """(seq, kind, value): one message text per event, in SQL that both engines read."""
    return f"SELECT seq, kind, {_DIRTY_VALUE} FROM (SELECT {', '.join(_DIRTY_KEYS)} FROM {events})"


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).selectExpr(*_DIRTY_KEYS).selectExpr("seq", "kind", _DIRTY_VALUE)


# How a drifting feed differs from the 40 text fields, as (event_id's modulus, remainder).
ADDED_TEXT, ADDED_NUMBER, ADDED_OBJECT = (5, 0), (8, 1), (10, 3)
DROPPED_OIL, NUMBER_CO2, LIST_SETPOINT, BROKEN = (7, 2), (11, 4), (13, 6), (97, 5)
_DRIFTING = ("Oil_Temperature_Sensor", "CO2_Level_PPM", "LWT_Setpoint")


def drift_case(rule: tuple[int, int]) -> str:
    return f"event_id % {rule[0]} = {rule[1]}"


def drifting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines (``value``), one per event: readings with added, missing and re-typed keys, and broken ones."""
    steady = ", ".join(f for f in RAW_FIELDS if f not in _DRIFTING)
    members = [
        f"""CASE WHEN {drift_case(DROPPED_OIL)} THEN '' ELSE ',"Oil_Temperature_Sensor":"' || Oil_Temperature_Sensor || '"' END""",
        f"""',"CO2_Level_PPM":' || CASE WHEN {drift_case(NUMBER_CO2)} THEN CO2_Level_PPM ELSE '"' || CO2_Level_PPM || '"' END""",
        f"""',"LWT_Setpoint":' || CASE WHEN {drift_case(LIST_SETPOINT)} THEN '[' || LWT_Setpoint || ',7]' ELSE '"' || LWT_Setpoint || '"' END""",
        f"""CASE WHEN {drift_case(ADDED_TEXT)} THEN ',"Firmware_Version":"v' || user_id || '"' ELSE '' END""",
        f"""CASE WHEN {drift_case(ADDED_NUMBER)} THEN ',"Vibration_mm_s":' || (event_id % 9) || '.5' ELSE '' END""",
        f"""CASE WHEN {drift_case(ADDED_OBJECT)} THEN ',"Diagnostics":{{"rpm":' || event_id || '}}' ELSE '' END""",
    ]
    rows = events_to_widen(spark, sf_dir).selectExpr("event_id", "user_id", *telemetry_select_list("spark"))
    whole = f"to_json(struct({steady}), map('ignoreNullFields', 'false'))"
    value = " || ".join(["substring(whole, 1, length(whole) - 1)", *members, "'}'"])
    rows = rows.selectExpr("event_id", "user_id", *_DRIFTING, f"{whole} AS whole")
    return rows.selectExpr(f"CASE WHEN {drift_case(BROKEN)} THEN '[' || event_id ELSE {value} END AS value")


def drifting_sql() -> str:
    """The 40 fields and ``extra`` (JSON text, keys in order) of ``drifting_lines``, for DuckDB."""
    exprs = dict(zip(RAW_FIELDS, telemetry_select_list("duckdb")))
    text = lambda f: exprs[f].rsplit(" AS ", 1)[0]
    exprs["Oil_Temperature_Sensor"] = f"CASE WHEN NOT {drift_case(DROPPED_OIL)} THEN {text('Oil_Temperature_Sensor')} END AS x"
    exprs["LWT_Setpoint"] = f"CASE WHEN {drift_case(LIST_SETPOINT)} THEN '[' || {text('LWT_Setpoint')} || ',7]' ELSE {text('LWT_Setpoint')} END AS x"
    fields = ",\n".join(f'CASE WHEN NOT {drift_case(BROKEN)} THEN {e.rsplit(" AS ", 1)[0]} END AS "{f}"' for f, e in exprs.items())
    parts = [
        (ADDED_OBJECT, """'"Diagnostics":{"rpm":' || event_id || '}'"""),
        (ADDED_TEXT, """'"Firmware_Version":"v' || user_id || '"'"""),
        (ADDED_NUMBER, """'"Vibration_mm_s":' || (event_id % 9) || '.5'"""),
    ]
    listed = ", ".join(f"CASE WHEN {drift_case(rule)} THEN {value} END" for rule, value in parts)
    some = " OR ".join(drift_case(rule) for rule, _ in parts)
    return f"SELECT {fields},\nCASE WHEN NOT {drift_case(BROKEN)} AND ({some}) THEN '{{' || concat_ws(',', {listed}) || '}}' END AS extra FROM events"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def events_to_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``events`` that readings are made of, dealt so that a task's readings are ``TASK_BYTES`` or so.

    A reading is ``WIDENED`` times as long as what Parquet stores of its event: the scan's splits (row groups, at most)
    would each become gigabytes of readings, which one task dedupes in memory, or writes to one file.
    """
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    events = spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type")
    parts = -(-(path_size_bytes(spark, path) or 0) * WIDENED // TASK_BYTES)
    return events.repartition(parts, *events.columns) if parts > 1 else events


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(events_to_widen(spark, sf_dir))


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_from_events(read_events(spark, sf_dir))


__all__ = [
    "DIRTY_KINDS",
    "SEQ_COLUMN",
    "dirty_messages",
    "dirty_messages_sql",
    "live",
    "live_from_events",
    "live_sql",
    "read_events",
    "telemetry",
    "telemetry_from_events",
    "telemetry_sql",
]
