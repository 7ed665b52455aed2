"""Stream sources: topic drain / tail, file-fed streams, JSON decoding.

A topic is read with the Kafka source when its connector is on the classpath
(not in the test image: those paths are untested here). Files are the tested
stand-in: each line is one message value, and the record carries an explicit
arrival column ``seq`` (Kafka would give partition/offset).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.schema import LIVE_SCHEMA, SEQ_COLUMN

CORRUPT = "_corrupt_record"


def live_schema_with_seq(schema: T.StructType = LIVE_SCHEMA, seq: str = SEQ_COLUMN) -> T.StructType:
    return T.StructType([T.StructField(seq, T.LongType(), True), *schema.fields])


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Raw Kafka stream: ``value`` as UTF-8 text plus an arrival order ``seq``.

    Offsets only order messages within one partition, so ``seq`` is the
    struct (broker timestamp, partition, offset): comparable across
    partitions, and usable by ``orderBy``/``max_by`` like a number. Expired
    offsets fail the stream, as Spark does by default; a caller who can do
    without them passes ``failOnDataLoss`` in ``options``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.struct(
            F.col("timestamp").alias("ts"), F.col("partition").alias("partition"), F.col("offset").alias("offset")
        ).alias(SEQ_COLUMN),
    )


def tail_topic(spark: SparkSession, bootstrap_servers: str, topic: str, options: dict | None = None) -> DataFrame:
    """Unbounded tail from the latest offsets."""
    return kafka_stream(spark, bootstrap_servers, topic, "latest", options)


def decode_topic(stream: DataFrame, schema: T.StructType = LIVE_SCHEMA) -> DataFrame:
    """Kafka records -> accepted typed records with their arrival ``seq``."""
    return accepted(decode_json_values(stream, schema, keep=(SEQ_COLUMN,)))


def file_value_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message values from text files: one line, one message (``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def decode_json_values(
    df: DataFrame,
    schema: T.StructType = LIVE_SCHEMA,
    value_column: str = "value",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Message text -> typed record, with a ``_corrupt_record`` column.

    A value is rejected (``_corrupt_record`` holds its text) when it is not
    one JSON object: malformed text, an array, a scalar or ``null`` (PERMISSIVE
    ``from_json`` reports all of these). A null or blank value is reported as
    ``""``. A missing field is null, and so is one whose value does not have
    the field's type: the record stays. Numbers may come as text, and a whole
    number as a decimal (``1000.0``) in an integer field.

    The text is parsed exactly once per message: the parsed struct is
    expanded by a one-element ``inline`` generator, which predicates (such as
    ``accepted``/F5 filters) cannot be pushed below - a plain projection would
    let the optimizer copy ``from_json`` into every filter and field. Works on
    batch and streaming DataFrames alike.
    """
    # parsed as text, so that no field's type can reject the message
    as_text = [T.StructField(f.name, T.StringType(), True) for f in schema.fields]
    with_corrupt = T.StructType([*as_text, T.StructField(CORRUPT, T.StringType(), True)])
    text = F.col(value_column).cast("string")
    blank = F.coalesce(F.length(F.trim(text)), F.lit(0)) == 0
    safe = F.when(blank, F.lit('""')).otherwise(text)
    parsed = F.from_json(safe, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = df.select(*[F.col(k) for k in keep], F.inline(F.array(parsed)))
    return rows.select(*keep, *[_typed(f).alias(f.name) for f in schema.fields], CORRUPT)


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return text
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        number = text.try_cast(T.DoubleType())
        return F.coalesce(value, F.when(number == F.floor(number), number.try_cast(field.dataType)))
    return value


def accepted(decoded: DataFrame) -> DataFrame:
    """Well-formed records only (the corrupt column dropped)."""
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(decoded: DataFrame) -> DataFrame:
    """The text of every message that failed to decode."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def empty_source_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``primary`` unless it has no rows, then the given ``fallback``.

    ``isEmpty`` runs a one-row probe job, not a count. The fallback is an
    argument (no simulator), and nothing is written here.
    """
    return fallback if primary.isEmpty() else primary
