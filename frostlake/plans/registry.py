"""The query registry behind ``__spark_entry__``.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame derived from
the driver's tables (the telemetry and live fixtures are Spark expressions
over ``events``), so each query's work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.operators import gold as G
from frostlake.operators.filters import fault_or_breach, nan_to_null
from frostlake.operators.silver import cast_sensors, silver
from frostlake.operators.staging import drop_exact_duplicates, drop_missing_critical, staging
from frostlake.plans import conformance as C
from frostlake.plans import increments as I
from frostlake.plans import oracle as O
from frostlake.plans import paging as P
from frostlake.plans import serving as S
from frostlake.plans.workspace import decoded_live_stream, workspace
from frostlake.schema import LIVE_FIELDS
from frostlake.session import path_exists, scratch_path
from frostlake.sinks import files as K
from frostlake.sources import drift as DR
from frostlake.sources import lake as LK
from frostlake.sources import resolution as RS
from frostlake.sources import topics as TP
from frostlake.sources import fixtures as FX
from frostlake.sources.fixtures import dirty_messages_sql, live, telemetry
from frostlake.streaming import live as L

Query = Callable[[SparkSession, str], DataFrame]

#: Gold tables that are also registered in the form kept up by day: one of each kind of state.
INCREMENTAL = ("dim_device", "fact_hourly_telemetry", "fact_fault_events", "mart_daily_costs", "mart_pump_maintenance")

#: Folders of a written lake that hold tables.
LAKE_FOLDERS = ("batch", "staging", "silver", *(f"gold/{t}" for t in G.GOLD_TABLES))


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(staging(telemetry(spark, sf_dir)))


def gold_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return G.gold_table(silver_of(spark, sf_dir), name)


def dashboard_daily_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.dashboard_daily_costs(gold_of(spark, sf_dir, "mart_daily_costs"))


def _medallion() -> dict[str, Query]:
    qs: dict[str, Query] = {
        "drop_missing_critical": lambda s, d: drop_missing_critical(telemetry(s, d)),
        "drop_exact_duplicates": lambda s, d: drop_exact_duplicates(telemetry(s, d)),
        "staging": lambda s, d: staging(telemetry(s, d)),
        "staging_by_digest": lambda s, d: staging(telemetry(s, d), by_digest=True),
        "cast_sensors": lambda s, d: cast_sensors(staging(telemetry(s, d))),
        "silver": silver_of,
    }
    for name in G.GOLD_TABLES:
        qs[name] = lambda s, d, _n=name: gold_of(s, d, _n)
    # the same tables in the shared one-pass form the pipeline runs
    for name in G.GOLD_TABLES:
        qs[f"shared_{name}"] = lambda s, d, _n=name: G.gold_tables(silver_of(s, d), "shared")[_n]
    # and from states that were added day by day
    for name in INCREMENTAL:
        qs[f"incremental_{name}"] = lambda s, d, _n=name: _incremental(s, d, _n)
    return qs


def _page_table_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 by a key with many ties: three pages in a row hold each row once."""
    df = gold_of(spark, sf_dir, "fact_hourly_telemetry")
    pages = [S.page_table(df, page, 50, ["Hour_of_Day"]) for page in (2, 3, 4)]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


def _seek_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 by bookmark and by a key with many ties: pages 1 and 2 are read for their bookmarks, page 3 is returned."""
    df, after = gold_of(spark, sf_dir, "fact_hourly_telemetry"), None
    for _ in range(2):
        page = P.seek_page(df, 50, after, ["Hour_of_Day"]).collect()
        after = P.next_bookmark(page, df, after, ["Hour_of_Day"])
    return P.seek_page(df, 50, after, ["Hour_of_Day"])


def _incremental(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Gold from day states: first the morning readings, then each half of the days anew, with their late readings."""
    return I.gold_from_states(spark, workspace(spark, sf_dir).gold_states)[name]


def _dashboard() -> dict[str, Query]:
    return {
        "dashboard_daily_costs": dashboard_daily_costs,
        "dashboard_sla_breaches": lambda s, d: S.dashboard_sla_breaches(gold_of(s, d, "mart_sla_breach_summary")),
        "dashboard_hourly_temperatures": lambda s, d: S.dashboard_hourly_temperatures(
            gold_of(s, d, "fact_hourly_telemetry")
        ),
        "dashboard_totals": lambda s, d: S.dashboard_totals(
            gold_of(s, d, "mart_daily_costs"), gold_of(s, d, "mart_sla_breach_summary")
        ),
        "page_table": lambda s, d: S.page_table(gold_of(s, d, "fact_hourly_telemetry"), page=3, limit=50),
        "page_table_ties": _page_table_ties,
        "seek_page": _seek_pages,
        "count_table": lambda s, d: S.count_table(silver_of(s, d)),
    }


def _filters() -> dict[str, Query]:
    return {
        "fault_or_breach": lambda s, d: fault_or_breach(silver_of(s, d)),
        "nan_to_null": lambda s, d: nan_to_null(silver_of(s, d)),
    }


# ------------------------------------------------------------- lake I/O


def _read_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LK.read_raw_json(spark, workspace(spark, sf_dir).raw_json)


def _raw_extra_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with ``_extra``, through a layer of its own; the VARIANT is shown as JSON."""
    root = scratch_path(spark, "drift_lake")
    K.write_layer(DR.read_raw_json_with_extra(spark, workspace(spark, sf_dir).drifting_json), LK.resolve_table(root, "batch"))
    back = LK.read_layer(spark, root, "batch")
    return back.select(*[c for c in back.columns if c != DR.EXTRA_COLUMN], F.to_json(DR.EXTRA_COLUMN).alias("extra"))


def _raw_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DR.schema_drift(DR.raw_lines(spark, workspace(spark, sf_dir).drifting_json))


def _land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "raw_landing")
    K.land_raw(spark, workspace(spark, sf_dir).raw_json, out)
    return LK.read_raw_json(spark, out)


def _read_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LK.read_layer(spark, workspace(spark, sf_dir).lake, "silver")


def _write_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: one write over another; the second is what the layer holds."""
    root, mart = scratch_path(spark, "layers"), gold_of(spark, sf_dir, "mart_daily_costs")
    path = LK.resolve_table(root, "gold", "mart_daily_costs")
    K.write_layer(mart.where("Daily_Cost_USD IS NULL"), path)
    K.write_layer(mart, path)
    return LK.read_layer(spark, root, "gold", "mart_daily_costs")


def _export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_of(spark, sf_dir, "mart_daily_costs")
    out = scratch_path(spark, "export_csv")
    K.export_csv(df, out)
    return spark.read.schema(df.schema).option("header", True).option("nullValue", "null").option(
        "escape", '"'
    ).csv(out)


def _export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gold_of(spark, sf_dir, "mart_daily_costs")
    out = scratch_path(spark, "export_json")
    K.export_json(df, out)
    return spark.read.schema(df.schema).json(out)


def _encode_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = K.encode_keyed_json(live(spark, sf_dir))
    out = scratch_path(spark, "keyed")
    keyed.write.parquet(out)
    back = spark.read.parquet(out)
    decoded = TP.decode_json_values(back, TP.live_schema_with_seq(), keep=("key",))
    return TP.accepted(decoded)


def _lake_io() -> dict[str, Query]:
    return {
        "read_raw_json": _read_raw_json,
        "raw_extra_keys": _raw_extra_keys,
        "raw_schema_drift": _raw_schema_drift,
        "land_raw": _land_raw,
        "read_layer": _read_layer,
        "write_layer": _write_layer,
        "export_csv": _export_csv,
        "export_json": _export_json,
        "encode_keyed_json": _encode_keyed_json,
        "pipeline_run_log": lambda s, d: s.read.parquet(f"{workspace(s, d).lake}/_runs"),
        "pipeline_run_rows": lambda s, d: s.read.parquet(f"{workspace(s, d).lake}/_runs").select("stage", "rows"),
        "lake_manifest": lambda s, d: K.lake_manifest(s, workspace(s, d).lake),
        "lake_manifest_rows": lambda s, d: K.layer_row_counts(s, workspace(s, d).lake, LAKE_FOLDERS),
    }


# ------------------------------------------------------------- serving over the lake


def lake_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: register every layer of the written lake, then count each view."""
    names = S.register_lake_views(spark, workspace(spark, sf_dir).lake)
    parts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("view_name"), "row_count")
        for n in names
    ]
    if not parts:
        return spark.createDataFrame([], "view_name string, row_count bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lake_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 with what each listed table holds: its rows and columns, as read from the lake."""
    lake = workspace(spark, sf_dir).lake
    sizes = None
    for layer, table in LK.list_lake_tables(spark, lake):
        df = LK.read_layer(spark, lake, layer, table)
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(S.view_name(layer, table)).alias("view_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        sizes = one if sizes is None else sizes.unionByName(one)
    return S.list_tables(spark, lake).join(sizes, "view_name")


def _register_gold_views(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], with_silver: bool) -> None:
    slv = silver_of(spark, sf_dir)
    frames = {f"gold_{t}": G.gold_table(slv, t) for t in tables}
    if with_silver:
        frames["silver"] = slv
    S.register_views(spark, frames)


def _conformance_query(key: str) -> Query:
    text, tables = C.CONFORMANCE[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _register_gold_views(spark, sf_dir, tables, with_silver="silver" in text)
        return S.run_sql(spark, text, views=[f"gold_{t}" for t in tables] + ["silver"])

    return run


def _run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _register_gold_views(spark, sf_dir, C.RUN_SQL_TABLES, with_silver=False)
    return S.run_sql(spark, C.RUN_SQL_EXAMPLE)


def _serving_lake() -> dict[str, Query]:
    out: dict[str, Query] = {
        "register_lake_views": lake_view_counts,
        "run_sql": _run_sql,
        "list_tables": lambda s, d: S.list_tables(s, workspace(s, d).lake),
        "list_table_sizes": lake_table_sizes,
    }
    for key in C.CONFORMANCE:
        out[key] = _conformance_query(key)
    return out


# ------------------------------------------------------------- streaming


def _drain_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second drain with the same checkpoint finds nothing new, so the
    given fallback (the live records of ``events``) is used."""
    ws = workspace(spark, sf_dir)
    ws.live_drained  # the first drain, which advances the drain checkpoint
    out = scratch_path(spark, "drain_again")
    L.start_dump_json(decoded_live_stream(spark, ws.live_json), out, ws.drain_checkpoint).awaitTermination()
    schema = TP.live_schema_with_seq()
    primary = spark.read.schema(schema).json(out) if path_exists(spark, out) else spark.createDataFrame([], schema)
    return TP.empty_source_fallback(primary, live(spark, sf_dir))


def _drain_until_quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 while messages still arrive: a third of them comes before each of the first three runs."""
    root, messages = scratch_path(spark, "arriving"), live(spark, sf_dir)
    parts = iter(range(3))

    def run():
        if (part := next(parts, None)) is not None:
            messages.where(F.pmod("seq", F.lit(3)) == part).write.option("ignoreNullFields", "false").mode("append").json(f"{root}/src")
        return L.start_dump_json(decoded_live_stream(spark, f"{root}/src"), f"{root}/out", f"{root}/_ckpt")

    L.drain_until_quiet(run, quiet_polls=2, pause=0.0)
    return spark.read.schema(TP.live_schema_with_seq()).json(f"{root}/out")


def _resolved(make) -> Query:
    """S7 with the reason beside each row; ``make(spark, sf_dir, path)`` reads a source that fails in one way."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "source")
        found = RS.resolve_source(spark, "live", lambda: make(spark, sf_dir, path), live(spark, sf_dir))
        return found.df.select(F.lit(found.used).alias("used"), F.lit(found.reason).alias("reason"), *found.df.columns)

    return run


def _unreadable(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Messages as text, read as if they were Parquet."""
    live(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return spark.read.schema(TP.live_schema_with_seq()).parquet(path)


def _emptied(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    live(spark, sf_dir).where("seq < 0").write.parquet(path)
    return spark.read.schema(TP.live_schema_with_seq()).parquet(path)


def _no_broker(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """A topic that cannot be reached: no connector is installed here, and no broker listens there."""
    topic = spark.read.format("kafka").option("kafka.bootstrap.servers", "localhost:1").option("subscribe", "live")
    return TP.accepted(TP.decode_json_values(topic.load(), TP.live_schema_with_seq()))


def _readable(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    live(spark, sf_dir).where("Entering_Chilled_Water_Temperature_Sensor IS NOT NULL").write.parquet(path)
    return spark.read.schema(TP.live_schema_with_seq()).parquet(path)


SOURCE_BRANCHES = {
    "source_ok": (_readable, "primary", RS.OK),
    "source_empty": (_emptied, "fallback", RS.EMPTY),
    "source_missing": (lambda s, d, path: s.read.schema(TP.live_schema_with_seq()).json(path), "fallback", RS.PATH_MISSING),
    "source_unreadable": (_unreadable, "fallback", RS.READ_ERROR),
    "source_unreachable": (_no_broker, "fallback", RS.UNREACHABLE),
}


def _tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live views as an unbounded query on a 1-second processing-time
    trigger, stopped once it has caught up. (A Kafka tail starts at the latest
    offsets; the file-fed stand-in starts at the first file.)"""
    ws = workspace(spark, sf_dir)
    checkpoint = scratch_path(spark, "tail")
    q = L.start_live_views(decoded_live_stream(spark, ws.live_json), checkpoint, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return L.read_live_views(spark, checkpoint)["last_n_readings"]


def _live_view(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return L.read_live_views(spark, workspace(spark, sf_dir).live_views)[name]

    return run


def _streaming() -> dict[str, Query]:
    schema = TP.live_schema_with_seq()
    out: dict[str, Query] = {
        "decode_json_values": lambda s, d: TP.accepted(
            TP.decode_json_values(s.read.text(workspace(s, d).live_json), schema)
        ),
        "drain_topic": lambda s, d: s.read.schema(schema).json(workspace(s, d).live_drained),
        "drain_until_quiet": _drain_until_quiet,
        "drain_dirty_topic": lambda s, d: s.read.schema(schema).json(workspace(s, d).dirty_accepted),
        "rejected_messages": lambda s, d: s.read.schema("message string").json(workspace(s, d).dirty_rejects),
        "live_non_null": lambda s, d: s.read.schema(schema).json(workspace(s, d).live_accepted),
        "empty_source_fallback": _drain_fallback,
        "tail_topic": _tail,
    }
    for name in ("last_n_readings", "latest_reading", "messages_received", "live_points", "live_kpis"):
        out[name] = _live_view(name)
    for name, (make, _, _) in SOURCE_BRANCHES.items():
        out[name] = _resolved(make)
    return out


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_medallion())
    out.update(_filters())
    out.update(_dashboard())
    out.update(_lake_io())
    out.update(_serving_lake())
    out.update(_streaming())
    return out


# ------------------------------------------------------------------ oracle

R2 = O.round2
HOURLY_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in (
        "Device_ID",
        "Date",
        "Hour_of_Day",
        "Operational_Shift",
        "Avg_Entering_Temp",
        "Avg_Leaving_Temp",
        "Avg_Power_kW",
        "Total_Cost_USD",
    )
)


def _dashboard_sql() -> dict[str, str]:
    return {
        "dashboard_daily_costs": O.with_layers(
            f"SELECT Date, {R2('SUM(Daily_Cost_USD)')} AS total_cost, {R2('SUM(Daily_Power_kW)')} AS total_power "
            "FROM gold_mart_daily_costs GROUP BY Date ORDER BY Date NULLS LAST",
            gold=("mart_daily_costs",),
        ),
        "dashboard_sla_breaches": O.with_layers(
            "SELECT Date, CAST(SUM(Total_Breaches) AS BIGINT) AS total_breaches "
            "FROM gold_mart_sla_breach_summary GROUP BY Date ORDER BY Date NULLS LAST",
            gold=("mart_sla_breach_summary",),
        ),
        "dashboard_hourly_temperatures": O.with_layers(
            f"SELECT Hour_of_Day, {R2('AVG(Avg_Entering_Temp)')} AS entering, "
            f"{R2('AVG(Avg_Leaving_Temp)')} AS leaving "
            "FROM gold_fact_hourly_telemetry GROUP BY Hour_of_Day ORDER BY Hour_of_Day NULLS LAST",
            gold=("fact_hourly_telemetry",),
        ),
        "dashboard_totals": O.with_layers(
            f"SELECT {R2('COALESCE((SELECT SUM(Daily_Cost_USD) FROM gold_mart_daily_costs), 0)')} AS total_cost, "
            f"{R2('COALESCE((SELECT SUM(Daily_Power_kW) FROM gold_mart_daily_costs), 0)')} AS total_power, "
            "CAST(COALESCE((SELECT SUM(Total_Breaches) FROM gold_mart_sla_breach_summary), 0) AS BIGINT) "
            "AS total_breaches",
            gold=("mart_daily_costs", "mart_sla_breach_summary"),
        ),
        "page_table": O.with_layers(
            f"SELECT * FROM gold_fact_hourly_telemetry ORDER BY {HOURLY_ORDER} LIMIT 50 OFFSET 100",
            gold=("fact_hourly_telemetry",),
        ),
        "page_table_ties": O.with_layers(
            f"SELECT * FROM gold_fact_hourly_telemetry ORDER BY Hour_of_Day ASC NULLS FIRST, {HOURLY_ORDER} LIMIT 150 OFFSET 50",
            gold=("fact_hourly_telemetry",),
        ),
        "seek_page": O.with_layers(
            f"SELECT * FROM gold_fact_hourly_telemetry ORDER BY Hour_of_Day ASC NULLS FIRST, {HOURLY_ORDER} LIMIT 50 OFFSET 100",
            gold=("fact_hourly_telemetry",),
        ),
        "count_table": O.with_layers("SELECT COUNT(*) AS total FROM silver"),
    }


def _filters_sql() -> dict[str, str]:
    return {
        "fault_or_breach": O.with_layers(
            "SELECT * FROM silver WHERE Active_Fault_Code != '0' OR SLA_Breach_Flag = 1"
        ),
        "nan_to_null": O.with_layers("SELECT * FROM silver"),
    }


def _row_counts(name: str) -> str:
    """The rows of each folder of the lake."""
    tables = {"batch": "telemetry"} | {f: f.replace("/", "_") for f in LAKE_FOLDERS if f != "batch"}
    return "\nUNION ALL\n".join(f"SELECT '{f}' AS {name}, COUNT(*) AS rows FROM {t}" for f, t in tables.items())


def _drift_sql() -> str:
    rows = [
        ("Firmware_Version", "added", "STRING", FX.ADDED_TEXT),
        ("Vibration_mm_s", "added", "DECIMAL", FX.ADDED_NUMBER),
        ("Diagnostics", "added", "OBJECT", FX.ADDED_OBJECT),
        ("Oil_Temperature_Sensor", "missing", None, FX.DROPPED_OIL),
        ("CO2_Level_PPM", "retyped", "BIGINT", FX.NUMBER_CO2),
        ("LWT_Setpoint", "retyped", "ARRAY", FX.LIST_SETPOINT),
    ]
    text = lambda v: f"'{v}'" if v else "CAST(NULL AS VARCHAR)"
    parts = [f"SELECT {text(k)} AS key, {text(d)} AS drift, {text(t)} AS type, {FX.drift_case(rule)} AND NOT {FX.drift_case(FX.BROKEN)} AS found FROM events" for k, d, t, rule in rows]
    parts.append(f"SELECT {text(None)}, 'malformed', {text(None)}, {FX.drift_case(FX.BROKEN)} FROM events")
    return "SELECT key, drift, type, count(*) AS records FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE found GROUP BY ALL"


def _lake_io_sql() -> dict[str, str]:
    # stages that write no table of their own, or many
    untimed = "\nUNION ALL\n".join(f"SELECT '{stage}' AS stage, CAST(NULL AS BIGINT) AS rows" for stage in ("raw", "gold", "total"))
    return {
        "read_raw_json": O.with_layers("SELECT * FROM telemetry", upto="telemetry"),
        "raw_extra_keys": FX.drifting_sql(),
        "raw_schema_drift": _drift_sql(),
        "land_raw": O.with_layers("SELECT * FROM telemetry", upto="telemetry"),
        "read_layer": O.with_layers("SELECT * FROM silver"),
        "write_layer": O.with_layers("SELECT * FROM gold_mart_daily_costs", gold=("mart_daily_costs",)),
        "export_csv": O.with_layers("SELECT * FROM gold_mart_daily_costs", gold=("mart_daily_costs",)),
        "export_json": O.with_layers("SELECT * FROM gold_mart_daily_costs", gold=("mart_daily_costs",)),
        "encode_keyed_json": O.with_live('SELECT "Device_ID" AS key, * FROM live'),
        "pipeline_run_rows": O.with_layers(f"{_row_counts('stage')}\nUNION ALL\n{untimed}", gold=G.GOLD_TABLES),
        "lake_manifest_rows": O.with_layers(_row_counts("layer"), gold=G.GOLD_TABLES),
    }


def _serving_lake_sql() -> dict[str, str]:
    counts = [
        "SELECT 'batch' AS view_name, COUNT(*) AS row_count FROM telemetry",
        "SELECT 'staging' AS view_name, COUNT(*) AS row_count FROM staging",
        "SELECT 'silver' AS view_name, COUNT(*) AS row_count FROM silver",
    ] + [f"SELECT 'gold_{t}' AS view_name, COUNT(*) AS row_count FROM gold_{t}" for t in G.GOLD_TABLES]
    catalogue = [("batch", None), ("staging", None), ("silver", None)] + [("gold", t) for t in sorted(G.GOLD_TABLES)]
    values = ", ".join(
        f"('{layer}', {'NULL' if t is None else repr(t)}, '{'gold_' + t if t else layer}')" for layer, t in catalogue
    )
    wide = {"batch": "telemetry", "staging": "staging", "silver": "silver"}
    sizes = "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, {'NULL' if t is None else repr(t)} AS \"table\", '{'gold_' + t if t else layer}' AS view_name, "
        f"(SELECT COUNT(*) FROM {wide.get(layer, f'gold_{t}')}) AS row_count, "
        f"CAST((SELECT COUNT(*) FROM (DESCRIBE SELECT * FROM {wide.get(layer, f'gold_{t}')})) AS INTEGER) AS column_count"
        for layer, t in catalogue
    )
    out = {
        "list_table_sizes": O.with_layers(sizes, gold=G.GOLD_TABLES),
        "list_tables": f'SELECT * FROM (VALUES {values}) AS c(layer, "table", view_name)',
        "register_lake_views": O.with_layers("\nUNION ALL\n".join(counts), gold=G.GOLD_TABLES),
        "run_sql": O.with_layers(C.RUN_SQL_EXAMPLE.rstrip(";"), gold=C.RUN_SQL_TABLES),
    }
    for key, (text, tables) in C.CONFORMANCE.items():
        out[key] = O.with_layers(text, gold=tables)
    return out


def _streaming_sql() -> dict[str, str]:
    cols = ", ".join(f'"{c}"' for c in ("seq",) + LIVE_FIELDS)
    ok = 'WHERE "Entering_Chilled_Water_Temperature_Sensor" IS NOT NULL'
    newest = f"SELECT {cols} FROM live {ok} ORDER BY seq DESC LIMIT 1"
    absent = ", ".join(
        f'CAST(NULL AS {"VARCHAR" if c == "timestamp" or c == "Active_Fault_Code" else "DOUBLE"}) AS "{c}"'
        for c in LIVE_FIELDS
        if c not in ("Device_ID", "Pump_Hours", "CO2_Level_PPM")
    )
    branches = {
        name: O.with_live(f"SELECT '{used}' AS used, '{reason}' AS reason, {cols} FROM live {ok if used == 'primary' else ''}")
        for name, (_, used, reason) in SOURCE_BRANCHES.items()
    }
    return branches | {
        "drain_dirty_topic": f"SELECT event_id AS seq, {absent}, 'C' || CAST(user_id AS VARCHAR) AS \"Device_ID\", "
        'CASE WHEN event_id % 9 <> 2 THEN CAST(event_id AS BIGINT) END AS "Pump_Hours", '
        'CASE WHEN event_id % 9 <> 4 THEN CAST(410 AS BIGINT) END AS "CO2_Level_PPM" FROM events WHERE event_id % 9 < 5',
        "rejected_messages": f"SELECT CASE WHEN trim(value) = '' THEN '\"\"' ELSE value END AS message "
        f"FROM ({dirty_messages_sql()}) WHERE kind >= 5",
        "decode_json_values": O.with_live(f"SELECT {cols} FROM live"),
        "drain_topic": O.with_live(f"SELECT {cols} FROM live"),
        "drain_until_quiet": O.with_live(f"SELECT {cols} FROM live"),
        "live_non_null": O.with_live(f"SELECT {cols} FROM live {ok}"),
        "empty_source_fallback": O.with_live(f"SELECT {cols} FROM live"),
        "last_n_readings": O.with_live(f"SELECT {cols} FROM live {ok} ORDER BY seq DESC LIMIT 100"),
        "tail_topic": O.with_live(f"SELECT {cols} FROM live {ok} ORDER BY seq DESC LIMIT 100"),
        "latest_reading": O.with_live(newest),
        "messages_received": O.with_live(f"SELECT COUNT(*) AS messages_received FROM live {ok}"),
        "live_points": O.with_live(
            "SELECT seq, TRY_CAST(\"timestamp\" AS TIMESTAMP) AS time, "
            '"Entering_Chilled_Water_Temperature_Sensor" AS enteringTemp, '
            '"Leaving_Chilled_Water_Temperature_Sensor" AS leavingTemp, '
            '"System_Power_Consumption_kW" AS power '
            f"FROM live {ok} ORDER BY seq DESC LIMIT 20"
        ),
        "live_kpis": O.with_live(
            'SELECT "System_Power_Consumption_kW" AS latest_power_kw, "Device_ID" AS device_id, '
            + O.round2('"Entering_Chilled_Water_Temperature_Sensor" - "Leaving_Chilled_Water_Temperature_Sensor"')
            + " AS temp_delta, "
            + """CASE WHEN "Active_Fault_Code" = '0' THEN 'Normal' ELSE "Active_Fault_Code" END AS fault_label """
            + f"FROM ({newest})"
        ),
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(O.medallion_oracles())
    for name in G.GOLD_TABLES:
        out[f"shared_{name}"] = out[name]
    out["staging_by_digest"] = out["staging"]
    for name in INCREMENTAL:
        out[f"incremental_{name}"] = out[name]
    out.update(_filters_sql())
    out.update(_dashboard_sql())
    out.update(_lake_io_sql())
    out.update(_serving_lake_sql())
    out.update(_streaming_sql())
    return out
