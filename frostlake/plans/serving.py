"""Serving queries over the lake: dashboard, paging, free SQL, catalogue.

These replace an API process that answered from the lake files with an
in-process SQL engine. Here every answer is a Spark DataFrame over lake views,
so a dashboard over 100 TB of telemetry is the same plan as over a sample.
"""

from __future__ import annotations

import warnings
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.functions.columns import round2
from frostlake.operators.filters import nan_to_null
from frostlake.operators.gold import GOLD_TABLES
from frostlake.plans import guard
from frostlake.sources.lake import LAYERS, TableNotFound, TableReadError, list_lake_tables, read_layer

DEFAULT_PAGE_LIMIT = 50
DEFAULT_SQL_CAP = 1000


def _maybe_round(c, rounding: str | None):
    return round2(c) if rounding == "round2" else c


# ------------------------------------------------------------- dashboard


def dashboard_daily_costs(mart_daily_costs: DataFrame, rounding: str | None = "round2") -> DataFrame:
    """Q1: cost and power per day over all devices, by date.

    The inputs already carry two decimals, so ``round2`` only removes
    summation-order noise; ``rounding=None`` gives the raw float sums.
    """
    return (
        mart_daily_costs.groupBy("Date")
        .agg(
            _maybe_round(F.sum("Daily_Cost_USD"), rounding).alias("total_cost"),
            _maybe_round(F.sum("Daily_Power_kW"), rounding).alias("total_power"),
        )
        .orderBy(F.col("Date").asc_nulls_last())
    )


def dashboard_sla_breaches(mart_sla_breach_summary: DataFrame) -> DataFrame:
    """Q2: SLA breaches per day, by date."""
    return (
        mart_sla_breach_summary.groupBy("Date")
        .agg(F.sum("Total_Breaches").alias("total_breaches"))
        .orderBy(F.col("Date").asc_nulls_last())
    )


def dashboard_hourly_temperatures(fact_hourly: DataFrame, rounding: str | None = "round2") -> DataFrame:
    """Q3: per hour of day, the unweighted mean of the hourly averages."""
    return (
        fact_hourly.groupBy("Hour_of_Day")
        .agg(
            _maybe_round(F.avg("Avg_Entering_Temp"), rounding).alias("entering"),
            _maybe_round(F.avg("Avg_Leaving_Temp"), rounding).alias("leaving"),
        )
        .orderBy(F.col("Hour_of_Day").asc_nulls_last())
    )


def dashboard_totals(
    mart_daily_costs: DataFrame, mart_sla_breach_summary: DataFrame, rounding: str | None = "round2"
) -> DataFrame:
    """Q4: grand totals of cost, power and breaches; nulls count as 0.

    One global aggregate over the union of the two marts' measure columns (no
    join): partial sums per split, one row in the end.
    """
    costs = mart_daily_costs.select(
        F.col("Daily_Cost_USD").alias("c"),
        F.col("Daily_Power_kW").alias("p"),
        F.lit(None).cast("bigint").alias("b"),
    )
    breaches = mart_sla_breach_summary.select(
        F.lit(None).cast("double").alias("c"),
        F.lit(None).cast("double").alias("p"),
        F.col("Total_Breaches").cast("bigint").alias("b"),
    )
    both = costs.unionByName(breaches)
    return both.agg(
        _maybe_round(F.coalesce(F.sum("c"), F.lit(0.0)), rounding).alias("total_cost"),
        _maybe_round(F.coalesce(F.sum("p"), F.lit(0.0)), rounding).alias("total_power"),
        F.coalesce(F.sum("b"), F.lit(0).cast("bigint")).alias("total_breaches"),
    )


# ------------------------------------------------------------- paging


def page_table(
    df: DataFrame,
    page: int = 1,
    limit: int = DEFAULT_PAGE_LIMIT,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Q5: rows ``(page-1)*limit .. page*limit`` in a stable order.

    Spark has no inherent row order, so pages only fit together under a total
    order: the columns of ``order_by``, then all others as tie-breakers.
    """
    if page < 1 or limit < 0:
        raise ValueError("page starts at 1 and limit must be >= 0")
    first = list(order_by or ())
    keys = [F.col(f"`{k}`").asc_nulls_first() for k in [*first, *(c for c in df.columns if c not in first)]]
    return df.orderBy(*keys).offset((page - 1) * limit).limit(limit)


def count_table(df: DataFrame) -> DataFrame:
    """Q6: total row count (Parquet footers answer it when nothing is filtered)."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def has_next_page(total: int, page: int, limit: int) -> bool:
    """Next page exists iff rows remain after this one (not 'page is full')."""
    return page * limit < total


# ------------------------------------------------------------- free SQL


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> list[str]:
    """Expose DataFrames as temp views (the lazy form of Q7)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def view_name(layer: str, table: str | None) -> str:
    return f"gold_{table}" if layer == "gold" else layer


def register_lake_views(spark: SparkSession, lake_root: str, fmt: str = "parquet") -> list[str]:
    """Q7: every existing layer as a view; gold tables as ``gold_<name>``.

    A layer that is missing is skipped; one that cannot be read only warns.
    """
    names = []
    for layer, table in list_lake_tables(spark, lake_root):
        try:
            read_layer(spark, lake_root, layer, table, fmt).createOrReplaceTempView(view_name(layer, table))
            names.append(view_name(layer, table))
        except (TableNotFound, TableReadError) as e:
            warnings.warn(f"could not register {layer}/{table}: {e}", stacklevel=2)
    return names


def clean_sql(text: str) -> str:
    text = text.strip()
    if text.endswith(";"):
        text = text[:-1].rstrip()
    return text


def run_sql(spark: SparkSession, text: str, cap: int | None = None, views: Collection[str] | None = None) -> DataFrame:
    """Q8: free SQL over the registered views; only queries run, no DDL or DML.

    Trims the text and one trailing ``;``. The statement is first analysed as a subquery, so
    that anything but a query fails before it can run, and its plan is checked (``plans.guard``):
    it may read the registered views (``views``; any temporary view without them) and use
    Spark's own relational operators and functions, but no paths, catalogue tables, script
    transforms, reflection or added functions. All rows are returned, or up to ``cap`` if it is
    given and the query has no limit of its own as its last step. NaN becomes null (F6).
    """
    text = clean_sql(text)
    guard.check_plan(guard.analysed(spark.sql(f"SELECT * FROM (\n{text}\n)")), views)
    df = spark.sql(text)
    own = cap is not None and guard.has_own_limit(df)
    df = nan_to_null(df)
    return df if cap is None or own else df.limit(cap)


# ------------------------------------------------------------- catalogue

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType(), False),
        T.StructField("table", T.StringType(), True),
        T.StructField("view_name", T.StringType(), False),
    ]
)


def list_tables(spark: SparkSession, lake_root: str | None = None) -> DataFrame:
    """Q9: the catalogue. With a lake root, the tables that exist there;
    without, every table the pipeline can produce."""
    if lake_root is None:
        pairs = [(layer, None) for layer in LAYERS if layer != "gold"] + [("gold", t) for t in GOLD_TABLES]
    else:
        pairs = list_lake_tables(spark, lake_root)
    rows = [(layer, table, view_name(layer, table)) for layer, table in pairs]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


# ------------------------------------------------------------- response shapes
#
# What the serving endpoints returned, as plain dicts (no HTTP server). Only
# bounded results reach the driver: one page, a capped free-SQL result, or
# dashboard aggregates (one row per day / hour).


def _records(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in nan_to_null(df).collect()]


def table_page_response(
    spark: SparkSession,
    lake_root: str,
    layer: str,
    table: str | None = None,
    page: int = 1,
    limit: int = DEFAULT_PAGE_LIMIT,
    order_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    log=None,
) -> dict:
    """Q5 + Q6 as a response: ``{"data", "pagination", "latency_ms"}``.
    With a ``RunLog``, the request's latency is logged as ``serve/page``."""
    import time

    started = time.time()
    df = read_layer(spark, lake_root, layer, table if layer == "gold" else None, fmt)
    data = _records(page_table(df, page, limit, order_by))
    total = count_table(df).collect()[0]["total"]
    if log is not None:
        log.record("serve/page", started, len(data))
    return {
        "data": data,
        "pagination": {"page": page, "limit": limit, "total": total, "has_next": has_next_page(total, page, limit)},
        "latency_ms": round((time.time() - started) * 1000, 2),
    }


def query_response(
    spark: SparkSession, lake_root: str | None, text: str, cap: int = DEFAULT_SQL_CAP, log=None, fmt: str = "parquet"
) -> dict:
    """Q7 + Q8 as a response: ``{"data", "truncated", "latency_ms"}`` (logged as
    ``serve/query`` when a ``RunLog`` is given). With a lake, its views are all that can be
    read. At most ``cap`` rows are sent, unless the query ends in a limit of its own, which
    then stands; ``truncated`` says that there are more."""
    import time

    started = time.time()
    views = register_lake_views(spark, lake_root, fmt) if lake_root else None
    df = run_sql(spark, text, views=views)
    own = guard.has_own_limit(spark.sql(clean_sql(text)))
    data = _records(df if own else df.limit(cap + 1))
    data, truncated = (data, False) if own else (data[:cap], len(data) > cap)
    if log is not None:
        log.record("serve/query", started, len(data))
    return {"data": data, "truncated": truncated, "latency_ms": round((time.time() - started) * 1000, 2)}


def dashboard_response(spark: SparkSession, lake_root: str, fmt: str = "parquet", log=None) -> dict:
    """Q1-Q4 as a response: ``{"metrics", "totals", "latency_ms"}`` (logged
    as ``serve/dashboard`` when a ``RunLog`` is given)."""
    import time

    started = time.time()
    daily = read_layer(spark, lake_root, "gold", "mart_daily_costs", fmt)
    sla = read_layer(spark, lake_root, "gold", "mart_sla_breach_summary", fmt)
    hourly = read_layer(spark, lake_root, "gold", "fact_hourly_telemetry", fmt)
    metrics = {
        "daily_costs": _records(dashboard_daily_costs(daily)),
        "sla_breaches": _records(dashboard_sla_breaches(sla)),
        "hourly_temperatures": _records(dashboard_hourly_temperatures(hourly)),
    }
    totals = _records(dashboard_totals(daily, sla))[0]
    if log is not None:
        log.record("serve/dashboard", started)
    return {"metrics": metrics, "totals": totals, "latency_ms": round((time.time() - started) * 1000, 2)}
