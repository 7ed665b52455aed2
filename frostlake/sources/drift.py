"""Schema drift of the raw JSON: what the fixed 40 text fields do not show.

The raw layer is read with a fixed schema, without an inference pass. These operators keep what that leaves out
(``_extra``, a VARIANT with the keys outside the 40), and count by key what differs from the schema: keys added, keys
missing, and values that are no text. Records are parsed as VARIANT, so any nesting passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.schema import RAW_FIELDS, RAW_SCHEMA

EXTRA_COLUMN = "_extra"

_LINE = "value"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines (``value``) that the JSON reader would read: blank ones are none."""
    return spark.read.text(path).where(F.trim(_LINE) != "")


def _members(line: Column | str) -> Column:
    """A record's members by key; null if the line is no JSON object, or has a key twice."""
    return F.try_parse_json(line).try_cast("map<string, variant>")


def _known() -> Column:
    return F.array(*[F.lit(f) for f in RAW_FIELDS])


def _is_known(key: Column) -> Column:
    return key.isin(*RAW_FIELDS)  # one look into a hash set, where array_contains would compare with each


def with_extra(lines: DataFrame) -> DataFrame:
    """Lines as raw readings (the 40 text fields, as ``read_raw_json`` gives them) with ``_extra``: an object of
    the keys outside the 40, null if there are none or the line is no JSON object. An object or list in a text
    field is its JSON without blanks (the file reader copies it with them)."""
    # keys are cheaper to list than members to parse; a line that only one of both can read has no extra either way
    some = F.exists(F.json_object_keys(_LINE), lambda k: ~_is_known(k))
    extra = F.when(some, F.map_filter(_members(_LINE), lambda k, v: ~_is_known(k)))
    corrupt = "_no_record"  # with it, a line that is not an object keeps its row
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(_LINE, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = lines.select(extra.alias("_members"), F.inline(F.array(parsed)))
    return rows.select(*RAW_FIELDS, F.when(F.size("_members") > 0, F.expr("to_variant_object(_members)")).alias(EXTRA_COLUMN))


def read_raw_json_with_extra(spark: SparkSession, path: str) -> DataFrame:
    """S1 that loses no key: the 40 text fields and ``_extra``. Writes to and reads from a layer as it is."""
    return with_extra(raw_lines(spark, path))


def observed_schema(readings: DataFrame) -> DataFrame:
    """One row, ``schema``: the schema that all of ``_extra`` has together, nested keys included."""
    return readings.agg(F.schema_of_variant_agg(EXTRA_COLUMN).alias("schema"))


def schema_drift(lines: DataFrame) -> DataFrame:
    """(key, drift, type, records): how many records differ from the 40 text fields, and in which key.

    ``drift`` is ``added`` (a key outside the 40), ``missing`` (a key of the 40 that the record lacks), ``retyped``
    (a value that is neither text nor null) or ``malformed`` (no JSON object; key null). ``type`` is the kind of the
    value that was found: STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, ARRAY, OBJECT or VOID (null). An
    aggregate over one pass: a record without drift adds no row to it.
    """
    known, one = _known(), "array<struct<key:string,drift:string,type:string>>"
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    entry = lambda key, drift, type_: F.struct(key.alias("key"), F.lit(drift).alias("drift"), type_.alias("type"))
    none = F.lit(None).cast("string")
    added = F.transform(
        F.map_entries(F.map_filter("m", lambda k, v: ~_is_known(k))), lambda e: entry(e["key"], "added", kind(e["value"]))
    )
    retyped = F.transform(
        F.map_entries(F.map_filter("m", lambda k, v: ~F.schema_of_variant(v).isin("STRING", "VOID") & _is_known(k))),
        lambda e: entry(e["key"], "retyped", kind(e["value"])),
    )
    missing = F.transform(F.array_except(known, F.map_keys("m")), lambda k: entry(k, "missing", none))
    malformed = F.array(entry(none, "malformed", none))
    found = F.when(F.col("m").isNull(), malformed.cast(one)).otherwise(F.concat(added.cast(one), retyped.cast(one), missing.cast(one)))
    entries = lines.select(_members(_LINE).alias("m")).select(F.inline(found))
    return entries.groupBy("key", "drift", "type").agg(F.count("*").alias("records"))
