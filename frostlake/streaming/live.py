"""Live views over the message stream: newest readings, latest, counts, KPIs.

Every operator has a batch form (a DataFrame function, also used as the test
oracle) and runs in Structured Streaming. ``start_live_views`` serves R1-R4 from
ONE streaming query: each message is read and parsed once, whatever the number of
views. What they need is the query's own state (``streaming.state``), committed
together with the source's offsets; ``read_live_views`` reads it as batch
DataFrames, and gives R5.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from frostlake.functions.columns import round2
from frostlake.operators.filters import live_non_null, live_present
from frostlake.schema import SEQ_COLUMN
from frostlake.streaming.state import has_state, read_state, start_newest

LAST_N_DEFAULT = 100
CHART_POINTS_DEFAULT = 20

# ------------------------------------------------------------------ batch forms


def last_n_readings(df: DataFrame, n: int = LAST_N_DEFAULT, order_col: str = SEQ_COLUMN) -> DataFrame:
    """The newest ``n`` messages, returned in arrival order.

    A top-k (``TakeOrderedAndProject``): each split keeps its own newest ``n``;
    no full sort and no single task ever holds more than ``n`` per split.
    """
    return df.orderBy(F.col(order_col).desc()).limit(n).orderBy(F.col(order_col).asc())


def latest_and_count(df: DataFrame, order_col: str = SEQ_COLUMN) -> DataFrame:
    """R2 + R3 in one global aggregate: newest message and message count."""
    cols = [c for c in df.columns]
    return df.agg(
        F.max_by(F.struct(*cols), F.col(order_col)).alias("latest"),
        F.count(F.lit(1)).alias("messages_received"),
    )


def latest_reading(df: DataFrame, order_col: str = SEQ_COLUMN) -> DataFrame:
    """R2: the newest message (no row when there is none)."""
    return latest_and_count(df, order_col).where(F.col("latest").isNotNull()).select("latest.*")


def messages_received(df: DataFrame) -> DataFrame:
    """Running count of accepted messages."""
    return df.agg(F.count(F.lit(1)).alias("messages_received"))


def live_points(df: DataFrame, n: int = CHART_POINTS_DEFAULT, order_col: str = SEQ_COLUMN) -> DataFrame:
    """Chart points of the newest ``n`` messages, oldest first."""
    return to_chart_points(last_n_readings(df, n, order_col), order_col)


def to_chart_points(df: DataFrame, order_col: str = SEQ_COLUMN) -> DataFrame:
    """``time`` is the message's ISO text read as a wall clock (TIMESTAMP_NTZ,
    as a browser reads an ISO time without offset): independent of the
    session time zone; null when the text is not a timestamp."""
    return df.select(
        F.col(order_col),
        F.col("timestamp").try_cast("timestamp_ntz").alias("time"),
        F.col("Entering_Chilled_Water_Temperature_Sensor").alias("enteringTemp"),
        F.col("Leaving_Chilled_Water_Temperature_Sensor").alias("leavingTemp"),
        F.col("System_Power_Consumption_kW").alias("power"),
    )


def live_kpis(latest: DataFrame) -> DataFrame:
    """KPI tiles from the latest message: power and device, entering -
    leaving to two decimals, and a fault label (``'0'`` is Normal)."""
    return latest.select(
        F.col("System_Power_Consumption_kW").alias("latest_power_kw"),
        F.col("Device_ID").alias("device_id"),
        round2(
            F.col("Entering_Chilled_Water_Temperature_Sensor") - F.col("Leaving_Chilled_Water_Temperature_Sensor")
        ).alias("temp_delta"),
        F.when(F.col("Active_Fault_Code") == "0", F.lit("Normal"))
        .otherwise(F.col("Active_Fault_Code"))
        .alias("fault_label"),
    )


# ------------------------------------------------------------------ stream forms


def start_dump_json(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, processing_time: str = "1 second"
) -> StreamingQuery:
    """K3 (stream form): append decoded records to JSON lines, exactly once
    through the file sink's own log."""
    w = (
        stream.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def start_dump_rejects(
    values: DataFrame, path: str, checkpoint: str, available_now: bool = True, processing_time: str = "1 second"
) -> StreamingQuery:
    """The text (``message``) of every message of ``values`` that is no JSON object, as
    JSON lines: nothing that S6 rejects is lost without a trace."""
    from frostlake.sources.topics import CORRUPT, decode_json_values, rejected

    # a JSON reader would take the corrupt column's own name for its report
    messages = rejected(decode_json_values(values)).withColumnRenamed(CORRUPT, "message")
    return start_dump_json(messages, path, checkpoint, available_now, processing_time)


def accepted_live(decoded_stream: DataFrame) -> DataFrame:
    """F5 over decoded records: the messages the live views count."""
    return live_non_null(decoded_stream)


# ------------------------------------------------------------------ all live views, one query


def start_live_views(
    decoded_stream: DataFrame,
    checkpoint: str,
    n: int = LAST_N_DEFAULT,
    order_col: str = SEQ_COLUMN,
    archive: str | None = None,
    available_now: bool = False,
    processing_time: str = "1 second",
) -> StreamingQuery:
    """Run R1-R4 as a single streaming query; the views are its state, under ``checkpoint``.

    With ``archive``, every decoded message also goes to that folder as JSON lines, exactly
    once; the views count those that pass F5.
    """
    return start_newest(decoded_stream, checkpoint, n, order_col, live_present(), archive, available_now=available_now, processing_time=processing_time)


def read_live_views(
    spark: SparkSession,
    checkpoint: str,
    n: int = LAST_N_DEFAULT,
    chart_n: int = CHART_POINTS_DEFAULT,
    order_col: str = SEQ_COLUMN,
) -> dict[str, DataFrame]:
    """Batch DataFrames of the live views as of the last committed batch (empty dict before the first one)."""
    if not has_state(spark, checkpoint):
        return {}
    newest = read_state(spark, checkpoint, "newest")
    latest = latest_reading(read_state(spark, checkpoint, "latest"), order_col)
    total = F.coalesce(F.sum("messages"), F.lit(0)).cast("bigint").alias("messages_received")
    return {
        "last_n_readings": last_n_readings(newest, n, order_col),
        "live_points": live_points(newest, chart_n, order_col),
        "latest_reading": latest,
        "messages_received": read_state(spark, checkpoint, "seen").agg(total),
        "live_kpis": live_kpis(latest),
    }


# ------------------------------------------------------------------ topic entry points


@dataclass(frozen=True)
class Drained:
    """What a drain did: ``rows`` read in ``runs`` runs; ``quiet`` says that it ended because nothing more came
    (otherwise its time was up)."""

    rows: int
    runs: int
    quiet: bool
    seconds: float


def drain_until_quiet(
    start: Callable[[], StreamingQuery], quiet_polls: int = 3, pause: float = 1.0, timeout: float = 300.0
) -> Drained:
    """Chase a source until it is quiet.

    ``start`` starts one ``availableNow`` run; all runs have the same checkpoint, so each reads what came since the
    one before. A run is quiet if it read no row and left the source's end offsets as they were; the drain ends after
    ``quiet_polls`` quiet runs in a row, with ``pause`` seconds before each further run. No run is started when
    ``timeout`` seconds have passed, so a source that never falls quiet does not keep the drain from ending. What was
    read is committed run by run: a drain that is ended or killed goes on where it was.
    """
    began, rows, runs, quiet, ends = time.time(), 0, 0, 0, None
    while quiet < quiet_polls:
        if runs:
            time.sleep(pause)
        if time.time() - began >= timeout:
            return Drained(rows, runs, False, time.time() - began)
        query = start()
        query.awaitTermination()
        progress = query.recentProgress
        read = sum(p["numInputRows"] for p in progress)
        now = [s["endOffset"] for s in progress[-1]["sources"]] if progress else ends
        moved = read or (ends is not None and now != ends)
        quiet = 0 if moved else quiet + 1
        rows, runs, ends = rows + read, runs + 1, now
    return Drained(rows, runs, True, time.time() - began)


def drain_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    out_path: str,
    checkpoint: str,
    options: dict | None = None,
    rejects_path: str | None = None,
    quiet_polls: int = 3,
    pause: float = 1.0,
    timeout: float = 300.0,
) -> Drained:
    """S4 + K3: drain everything not yet consumed (from the earliest offsets
    on the first run, then from the checkpoint) into JSON lines, until the topic
    is quiet (``drain_until_quiet``).

    A second drain reads only what arrived since. With ``rejects_path``, a
    query with its own checkpoint (``<checkpoint>-rejects``) then writes the
    messages that are no JSON object there. Needs the Kafka connector.
    """
    from frostlake.sources.topics import decode_topic, kafka_stream

    values = kafka_stream(spark, bootstrap_servers, topic, "earliest", options)
    found = drain_until_quiet(lambda: start_dump_json(decode_topic(values), out_path, checkpoint, available_now=True), quiet_polls, pause, timeout)
    if rejects_path:
        start_dump_rejects(values, rejects_path, f"{checkpoint.rstrip('/')}-rejects").awaitTermination()
    return found


def tail_topic_views(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    checkpoint: str,
    options: dict | None = None,
    archive: str | None = None,
    processing_time: str = "1 second",
) -> StreamingQuery:
    """S5 + R1-R4: tail the topic from the latest offsets and keep the live
    views current every ``processing_time``. Needs the Kafka connector."""
    from frostlake.sources.topics import decode_topic, tail_topic

    stream = decode_topic(tail_topic(spark, bootstrap_servers, topic, options))
    return start_live_views(stream, checkpoint, archive=archive, processing_time=processing_time)
