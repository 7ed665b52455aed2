"""Lake sources: raw JSON lines and path-addressed layers.

A lake root holds ``batch``, ``staging``, ``silver`` and ``gold/<table>``.
The storage format is a parameter: ``parquet`` by default, ``delta`` where
that connector is on the classpath (not available here, so untested).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from frostlake.schema import RAW_SCHEMA
from frostlake.session import list_subdirs, path_exists
from frostlake.sources.versions import current_path, has_data

LAYERS = ("batch", "staging", "silver", "gold")
CORRUPT_COLUMN = "_corrupt_record"


class TableNotFound(LookupError):
    """The requested layer/table has no data at its path."""


class TableReadError(RuntimeError):
    """The path exists but could not be read as a table."""


def read_raw_json(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Line-delimited JSON with the fixed 40-field text schema.

    An explicit schema avoids the inference pass (a full extra scan of the raw
    files) and keeps field order stable. Malformed lines become all-null rows,
    or keep their text in ``_corrupt_record`` when ``keep_corrupt``.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    schema = RAW_SCHEMA
    if keep_corrupt:
        # a new StructType: .add() would mutate the shared RAW_SCHEMA
        schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).json(path)


def delta_available(spark: SparkSession) -> bool:
    """Whether the Delta Lake data source is on the classpath."""
    try:
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName("org.apache.spark.sql.delta.sources.DeltaDataSource")
        return True
    except Exception:  # noqa: BLE001 - not installed, or no JVM access (Connect)
        return False


def resolve_format(spark: SparkSession, fmt: str = "auto") -> str:
    """``auto`` picks ``delta`` when available, else ``parquet``."""
    if fmt != "auto":
        return fmt
    return "delta" if delta_available(spark) else "parquet"


def lake_format(spark: SparkSession, lake_root: str) -> str:
    """The format a lake was written in: ``delta`` when its layers carry a
    Delta log, else ``parquet`` (metadata only)."""
    root = lake_root.rstrip("/")
    for layer in ("silver", "staging", "batch"):
        if path_exists(spark, f"{root}/{layer}/_delta_log"):
            return "delta"
    return "parquet"


def conform_raw(df: DataFrame) -> DataFrame:
    """Bring any raw DataFrame to the 40-field text shape: known fields are
    rendered as text (a JSON number becomes its text), missing fields are
    null, unknown fields are dropped - as ``read_raw_json`` reads files."""
    from pyspark.sql import functions as F

    present = {c.lower(): c for c in df.columns}
    cols = [
        (F.col(present[f.lower()]).cast("string") if f.lower() in present else F.lit(None).cast("string")).alias(f)
        for f in RAW_SCHEMA.fieldNames()
    ]
    return df.select(*cols)


def resolve_table(lake_root: str, layer: str, table: str | None = None) -> str:
    """S3: path of a layer; only gold has sub-tables, other layers ignore ``table``."""
    if layer not in LAYERS:
        raise TableNotFound(f"unknown layer {layer!r}")
    root = lake_root.rstrip("/")
    if layer == "gold":
        if not table:
            raise TableNotFound("a gold table name is required")
        return f"{root}/gold/{table}"
    return f"{root}/{layer}"


def read_layer(
    spark: SparkSession, lake_root: str, layer: str, table: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """S2 + S3: load a layer by name, in its current version; a missing path raises
    ``TableNotFound``. Writes that end later do not change what is read."""
    path = resolve_table(lake_root, layer, table)
    if not path_exists(spark, path):
        raise TableNotFound(f"table path not found: {path}")
    try:
        return spark.read.format(fmt).load(current_path(spark, path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise TableNotFound(f"table path not found: {path}") from e
        raise TableReadError(f"error reading {path}: {e}") from e


def list_lake_tables(spark: SparkSession, lake_root: str) -> list[tuple[str, str | None]]:
    """(layer, table) pairs present under ``lake_root`` (metadata only)."""
    out: list[tuple[str, str | None]] = []
    for layer in ("batch", "staging", "silver"):
        if has_data(spark, resolve_table(lake_root, layer)):
            out.append((layer, None))
    gold_root = f"{lake_root.rstrip('/')}/gold"
    for name in _list_dirs(spark, gold_root):
        if has_data(spark, f"{gold_root}/{name}"):
            out.append(("gold", name))
    return out


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    return [d for d in list_subdirs(spark, path) if not d.startswith(("_", "."))]
