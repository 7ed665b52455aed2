"""The batch pipeline: raw -> batch -> staging -> silver -> 15 gold tables.

Each layer is a pure function of the one before and hands over only through
storage (each stage re-reads what the previous one wrote), so a failed run can
restart from the last written layer and every layer is a reproducible
snapshot. Sources are arguments: the pipeline never writes its own input.

Scale notes
-----------
* raw -> batch reads JSON with a fixed schema (no inference pass).
* staging is the one wide step over the full data: a hash aggregate on all
  columns, partially combined before the shuffle. Its shuffle width is derived
  from the batch layer's size on storage (``shuffle_partitions_for``), never
  below the session default; AQE coalesces small partitions.
* silver is written range-clustered by day, hour and device, so that a
  device-hour lies in one or two files: gold's partial aggregates then shrink
  to about one row a group before their shuffle, files hold few days (pruned
  by their footers), and ``partition_by=("Date",)`` writes few files a day. A
  device-hour that holds much of the data is split by its readings' times.
* gold's shuffles are sized from silver's bytes, as staging's from batch's.
* gold (shared form) scans silver twice: once into hourly partial states,
  once for the three off-grain dimensions. Both results are small and are
  written as Parquet tables in the shared checkpoint folder (computed once,
  lineage cut, column-pruned per mart), so the 15 table writes reuse them and
  an executor loss does not recompute silver.
* the 15 gold writes are independent jobs and are submitted concurrently
  (``max_concurrent_writes``), so their fixed per-job costs overlap.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.operators import gold as G
from frostlake.operators.silver import DEFAULT_RULES, SilverRules, reading_day_hour, silver
from frostlake.operators.staging import staging
from frostlake.session import delete_path, shuffle_partitions_for
from frostlake.sinks.files import RunLog, land_raw, materialize, write_layer
from frostlake.sources.drift import raw_lines, schema_drift
from frostlake.sources.lake import conform_raw, read_layer, read_raw_json, resolve_table
from frostlake.sources.resolution import resolve_source
from frostlake.sources.versions import current_path


@dataclass(frozen=True)
class PipelineConfig:
    fmt: str = "parquet"
    rules: SilverRules = DEFAULT_RULES
    gold_form: str = "shared"
    overwrite_schema: bool = False
    silver_partition_by: tuple[str, ...] = ()
    run_log: bool = True
    max_concurrent_writes: int = 4
    land_raw: bool = True
    drift_report: bool = False
    dedupe_by_digest: bool = False


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int):
    """Run the enclosed actions with ``spark.sql.shuffle.partitions = n``."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _width(spark: SparkSession, lake_root: str, layer: str) -> int:
    """Shuffle width for all of a layer, by the bytes of its current version."""
    return shuffle_partitions_for(spark, current_path(spark, resolve_table(lake_root, layer)))


def clustered(df: DataFrame, partitions: int, rules: SilverRules | None = None) -> DataFrame:
    """``df`` in ranges of day, hour and device; the hash of a reading's time
    splits a device-hour that is larger than a range.

    With ``rules``, ``df`` is staging, whose day and hour are computed by those
    rules. Spark evaluates what lies below a range shuffle a second time, for
    the bounds; over staging that is a scan, over silver the whole projection,
    and silver's derived columns need not be shuffled either.
    """
    day, hour = (F.col("Date"), F.col("Hour_of_Day")) if rules is None else reading_day_hour(rules)
    return df.repartitionByRange(partitions, day, hour, F.col("Device_ID"), F.xxhash64("timestamp"))


def build_gold(
    spark: SparkSession,
    silver_df: DataFrame,
    form: str = "shared",
    rounding: str = "round2",
    scratch: list[str] | None = None,
) -> dict:
    """The 15 gold DataFrames. In the shared form the two intermediate
    aggregates are materialized once; their paths are appended to
    ``scratch`` so the caller can remove them after the writes."""
    if form == "direct":
        return G.gold_tables(silver_df, "direct", rounding)
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_partials = pool.submit(materialize, G.hourly_partials(silver_df), "gold-hourly-partials")
        f_dims = pool.submit(materialize, G.dimension_sets(silver_df), "gold-dimension-sets")
        (partials, p1), (dims, p2) = f_partials.result(), f_dims.result()
    if scratch is not None:
        scratch += [p1, p2]
    tables = G.gold_from_partials(partials, rounding)
    tables.update(G.dims_from_sets(dims))
    tables["fact_fault_events"] = G.fact_fault_events(silver_df)
    return {name: tables[name] for name in G.GOLD_TABLES}


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame | str,
    lake_root: str,
    config: PipelineConfig = PipelineConfig(),
    fallback: DataFrame | None = None,
) -> RunLog:
    """Run every stage and return the run log (also appended to ``_runs``).

    With a ``fallback``, raw files that are missing, empty or unreadable give way to it (S7); what was used,
    and why, is appended to ``_sources``. ``drift_report`` writes the raw files' ``schema_drift`` to ``_drift``.
    """
    log = RunLog()
    fmt = config.fmt

    if isinstance(raw, str) and fallback is not None:
        t, path = time.time(), raw
        found = resolve_source(spark, path, lambda: read_raw_json(spark, path), fallback)
        found.append_to(spark, f"{lake_root.rstrip('/')}/_sources")
        raw = raw if found.used == "primary" else found.df
        log.record(f"source/{found.reason}", t)

    if isinstance(raw, str) and config.drift_report:
        t = time.time()
        schema_drift(raw_lines(spark, raw)).write.mode("overwrite").parquet(f"{lake_root.rstrip('/')}/_drift")
        log.record("drift", t)

    if isinstance(raw, str) and config.land_raw:
        t = time.time()
        land_raw(spark, raw, f"{lake_root.rstrip('/')}/raw")  # K2: untouched copy of the input
        log.record("raw", t)

    t = time.time()
    raw_df = read_raw_json(spark, raw) if isinstance(raw, str) else conform_raw(raw)
    n = write_layer(raw_df, resolve_table(lake_root, "batch"), fmt, config.overwrite_schema)
    log.record("batch", t, n)

    t = time.time()
    batch = read_layer(spark, lake_root, "batch", fmt=fmt)
    # the one full-data shuffle: size it from the batch layer's bytes
    width = _width(spark, lake_root, "batch")
    with _shuffle_partitions(spark, width):
        n = write_layer(staging(batch, config.dedupe_by_digest), resolve_table(lake_root, "staging"), fmt, config.overwrite_schema)
    log.record("staging", t, n)

    t = time.time()
    stg = read_layer(spark, lake_root, "staging", fmt=fmt)
    width = _width(spark, lake_root, "staging")
    n = write_layer(
        silver(clustered(stg, width, config.rules), config.rules),
        resolve_table(lake_root, "silver"),
        fmt,
        config.overwrite_schema,
        partition_by=config.silver_partition_by or None,
    )
    log.record("silver", t, n)

    t_gold = time.time()
    slv = read_layer(spark, lake_root, "silver", fmt=fmt)
    scratch: list[str] = []
    with _shuffle_partitions(spark, _width(spark, lake_root, "silver")):
        tables = build_gold(spark, slv, config.gold_form, config.rules.rounding, scratch)

    def write_one(item):
        name, df = item
        t = time.time()
        n = write_layer(df, resolve_table(lake_root, "gold", name), fmt, config.overwrite_schema)
        return name, t, time.time() - t, n

    with ThreadPoolExecutor(max_workers=max(1, config.max_concurrent_writes)) as pool:
        done = list(pool.map(write_one, tables.items()))
    for name, t, secs, n in done:
        log.add(f"gold/{name}", t, secs, n)
    for path in scratch:
        delete_path(spark, path)
    log.record("gold", t_gold)
    log.close()
    if config.run_log:
        log.append_to(spark, f"{lake_root.rstrip('/')}/_runs")
    return log
