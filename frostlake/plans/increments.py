"""Gold kept up by day: mergeable states of each day, replaced when the day's readings change.

A refresh aggregates the silver readings of some days into states (hourly partial sums, counts and maxima, the days' own
values of the dimensions, fault events) and adds them to ``<lake>/_gold_states``. Gold is then rolled up from the states,
without a look at silver: a new day costs that day, and the states are no more than one row per device and hour.

The states of a day are always of the whole day, and of several refreshes of a day the last one counts. So a refresh
that is run again, or a day whose late readings came in, never counts a reading twice; and copies of a reading have one
day, so that staging's dedupe holds. A refresh counts once its list of days is written, which is its last step; one
that fails before changes nothing. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.operators import gold as G
from frostlake.session import list_subdirs
from frostlake.sinks.files import write_layer
from frostlake.sources.versions import committed, current_path

#: Parts of a refresh; the last one is written last and makes the refresh count.
PARTS = ("hourly", "dimensions", "faults", "days")


def merge_hourly(states: DataFrame) -> DataFrame:
    """States of equal hourly keys as one: maxima by max, sums and counts by sum."""
    merged = [
        (F.max(c) if c.startswith("m__") else F.sum(c)).alias(c) for c in states.columns if c not in G.HOURLY_KEYS
    ]
    return states.groupBy(*G.HOURLY_KEYS).agg(*merged)


def _states_root(lake_root: str) -> str:
    return f"{lake_root.rstrip('/')}/_gold_states"


def _refreshes(spark: SparkSession, lake_root: str) -> list[str]:
    """Folders of the refreshes that count (metadata only)."""
    root = _states_root(lake_root)
    return [f"{root}/{n}" for n in list_subdirs(spark, root) if committed(spark, f"{root}/{n}/days")]


def _of_days(silver: DataFrame, days: Collection[dt.date | None]) -> DataFrame:
    some = F.col("Date").isin([d for d in days if d is not None])
    return silver.where(some | F.col("Date").isNull() if None in days else some)


def refresh_days(silver: DataFrame, lake_root: str, days: Collection[dt.date | None] | None = None) -> str:
    """Add the states of ``days`` as they are in ``silver``; returns the refresh's folder.

    None among the days stands for readings without a time; ``days=None`` for every day that ``silver`` has. A named day
    without readings loses what it had. ``silver`` must hold these days whole.
    """
    spark = silver.sparkSession
    root = _states_root(lake_root)
    number = 1 + max((int(n) for n in list_subdirs(spark, root) if n.isdigit()), default=0)
    folder = f"{root}/{number:010d}"
    own = silver if days is None else _of_days(silver, days)
    off_grain = [c for cols in G.DIM_SETS.values() for c in cols]
    sets = [["Date", *cols] for cols in G.DIM_SETS.values()]
    parts = {
        "hourly": G.hourly_partials(own),
        # the day is in every set, so that the others keep the grouping ids of the sets without it
        "dimensions": own.groupingSets([[F.col(c) for c in s] for s in sets], "Date", *off_grain).agg(F.grouping_id().alias("gid")),
        "faults": G.fact_fault_events(own, extra=("Date",)),
    }
    for name, df in parts.items():
        write_layer(df.withColumn("refresh", F.lit(number)), f"{folder}/{name}")
    if days is None:
        listed = spark.read.parquet(current_path(spark, f"{folder}/hourly")).select("Date").distinct()
    else:
        listed = spark.createDataFrame([(d,) for d in set(days)], T.StructType([T.StructField("Date", T.DateType())]))
    write_layer(listed.withColumn("refresh", F.lit(number)), f"{folder}/days")
    return folder


def gold_from_states(spark: SparkSession, lake_root: str, rounding: str = "round2") -> dict[str, DataFrame]:
    """The 15 gold tables from the states of each day's last refresh. At least one refresh must be there."""
    folders = _refreshes(spark, lake_root)
    if not folders:
        raise ValueError(f"no states under {_states_root(lake_root)}: call refresh_days first")

    def part(name: str) -> DataFrame:
        return spark.read.parquet(*[current_path(spark, f"{f}/{name}") for f in folders])

    last = part("days").groupBy(F.col("Date").alias("day")).agg(F.max("refresh").alias("last"))

    def current(name: str) -> DataFrame:
        df = part(name)
        return df.join(last, df["Date"].eqNullSafe(last["day"]) & (df["refresh"] == last["last"])).select(*df.columns).drop("refresh")

    tables = G.gold_from_partials(merge_hourly(current("hourly")), rounding)
    tables.update({name: df.distinct() for name, df in G.dims_from_sets(current("dimensions")).items()})
    tables["fact_fault_events"] = current("faults").select(*G.FACT_FAULT_COLUMNS)
    return {name: tables[name] for name in G.GOLD_TABLES}
