"""Lake sinks: layer snapshots, raw landing, exports, run log and manifest."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.session import hadoop_fs, path_exists, scratch_path
from frostlake.sources import versions as V
from frostlake.sources.lake import list_lake_tables, resolve_table


class SchemaMismatch(ValueError):
    """An overwrite would change the schema of an existing layer."""


def _schema_signature(schema: T.StructType) -> list[tuple[str, str]]:
    """Column names and types, order-insensitive (partition columns are read
    back last, which is not a schema change)."""
    return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)


def write_layer(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    overwrite_schema: bool = False,
    partition_by: Sequence[str] | None = None,
    observe_rows: bool = True,
) -> int | None:
    """K1: full-snapshot overwrite of a layer, atomic.

    Like a table format would, an overwrite that changes the column names or
    types of an existing layer fails unless ``overwrite_schema``. The check
    reads only file metadata. The number of rows written is collected by an
    ``Observation`` during the write itself (no second job) and returned.

    The rows go to a new version's folder, which becomes the layer by one atomic
    step after the write (``sources.versions``; read it with ``read_layer`` or at
    ``current_path``). A write that fails leaves the old version as it was. Of
    two writers of one layer, the one whose version is the later stays. Delta
    layers are left to Delta's own log.
    """
    spark = df.sparkSession
    versioned = fmt != "delta"
    if path_exists(spark, path) and not overwrite_schema:
        try:
            old = spark.read.format(fmt).load(V.current_path(spark, path) if versioned else path).schema
        except AnalysisException as e:  # an empty folder has nothing to protect; any other failure stops the write
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            old = None
        if old is not None and _schema_signature(old) != _schema_signature(df.schema):
            raise SchemaMismatch(
                f"schema of {path} would change; pass overwrite_schema=True to replace it.\n"
                f"old: {_schema_signature(old)}\nnew: {_schema_signature(df.schema)}"
            )
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}") if observe_rows else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    writer = out.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if versioned:
        version = V.new_version(spark, path)
        writer.save(f"{path.rstrip('/')}/{version}")
        V.commit(spark, path, version)
    else:
        writer = writer.mode("overwrite")
        (writer.option("overwriteSchema", "true") if overwrite_schema else writer).save(path)
    return int(obs.get["rows"]) if obs else None


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: computed once, lineage cut, survives executor loss.
    Returns the new DataFrame and the table's path (for later clean-up)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path), path


#: Text that repeats its keys in every line is written as gzip, at the level that costs least time.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def land_raw(spark: SparkSession, source_path: str, raw_dir: str) -> None:
    """K2: keep an untouched, line-for-line copy of the raw input, as gzip files of one input split each."""
    spark.read.text(source_path).write.mode("overwrite").options(**PACKED).text(raw_dir)


def dump_json(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = False) -> None:
    """K3 (batch form): records as JSON lines, nulls written as ``null``; ``packed``: as gzip files. A gzip file is
    read by one task, so ``df``'s partitions should be of a task's size."""
    df.write.mode(mode).options(ignoreNullFields="false", **(PACKED if packed else {})).json(path)


def encode_keyed_json(df: DataFrame, key_column: str = "Device_ID") -> DataFrame:
    """K4: ``(key, value)`` records for a topic: the key is the device, the
    value the whole record as JSON (nulls kept), so one device's readings land
    in one topic partition and keep their order."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.col(key_column).cast("string").alias("key"), value.alias("value"))


def write_topic(keyed: DataFrame, bootstrap_servers: str, topic: str, options: dict | None = None) -> None:
    """Publish ``(key, value)`` rows with the Kafka connector (needs its jar;
    not available in the test image, so untested here)."""
    w = keyed.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K5: CSV with a header, every value quoted, null as ``null``, quotes
    inside values escaped by doubling."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("nullValue", "null")
        .option("escape", '"')
        .csv(path)
    )


def export_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K6: JSON lines with nulls kept."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# ------------------------------------------------------------------ run log

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("seconds", T.DoubleType(), False),
        T.StructField("rows", T.LongType(), True),
    ]
)


@dataclass
class RunLog:
    """K7: seconds (and rows written) per stage of one run, in order."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    entries: list[tuple] = field(default_factory=list)
    _t0: float = field(default_factory=time.time)

    def record(self, stage: str, started: float, rows: int | None = None) -> float:
        """Log a stage that started at ``started`` and ends now."""
        return self.add(stage, started, time.time() - started, rows)

    def add(self, stage: str, started: float, seconds: float, rows: int | None = None) -> float:
        when = dt.datetime.fromtimestamp(started, tz=dt.timezone.utc)
        self.entries.append((self.run_id, len(self.entries), stage, when, seconds, rows))
        return seconds

    @contextmanager
    def timed(self, stage: str, rows: int | None = None):
        """Time a block, e.g. one serving request, as a stage of this log."""
        started = time.time()
        try:
            yield
        finally:
            self.record(stage, started, rows)

    def close(self) -> float:
        return self.record("total", self._t0)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, RUN_LOG_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("append").parquet(path)

    def as_dict(self) -> dict[str, float]:
        return {e[2]: e[4] for e in self.entries}

    def to_text(self) -> str:
        """The run as readable lines, one per stage, total last."""
        lines = [f"run {self.run_id}"]
        for _, _, stage, when, secs, rows in self.entries:
            extra = f", {rows} rows" if rows is not None else ""
            lines.append(f"[{stage}] started {when:%Y-%m-%d %H:%M:%S} UTC, {secs:.2f}s{extra}")
        return "\n".join(lines)


# ------------------------------------------------------------------ manifest


FILE_STATUS_SCHEMA = "path string, length bigint, modificationTime timestamp"


def _hidden_files(spark: SparkSession, root: str) -> list[tuple]:
    """Files that the file source skips: those with a ``_`` or ``.`` name, or
    in such a folder (``_SUCCESS``, ``_runs``, a table log). Globbed level by
    level inside the file system, so that only their names reach Python."""
    fs, top = hadoop_fs(spark, root)
    glob = lambda text: fs.globStatus(hadoop_fs(spark, text)[1]) or ()
    found: dict[str, tuple] = {}
    level = top.toString()
    while len(glob(f"{level}/*")):
        for st in glob(f"{level}/{{_,.}}*"):
            inside = fs.listFiles(st.getPath(), True)
            while inside.hasNext():
                file = inside.next()
                path, when = file.getPath().toString(), dt.datetime.fromtimestamp(file.getModificationTime() / 1000, tz=dt.timezone.utc)
                found[path] = (path, file.getLen(), when)
        level += "/*"
    return list(found.values())


def lake_manifest(spark: SparkSession, root: str, hidden: bool = False) -> DataFrame:
    """K8: every data file under ``root`` with its path relative to the root.

    ``binaryFile`` only reads file contents when the ``content`` column is
    selected, so this is a distributed listing. Of a layer's versions the
    current one is listed. The source skips hidden
    names; with ``hidden`` those files (table logs, run logs, markers) are
    listed too, so that a copy made from the manifest is a whole lake.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).drop("content")
    if hidden:
        files = files.unionByName(spark.createDataFrame(_hidden_files(spark, root), FILE_STATUS_SCHEMA))
    # names of versions are unique: one list for all layers, a name each
    current = [n for layer, table in list_lake_tables(spark, root) for n in V.committed(spark, resolve_table(root, layer, table))[-1:]]
    version = F.regexp_extract("path", V.VERSION_IN_PATH, 1)
    marker = F.regexp_extract("path", f"/{V.COMMITS}/([^/]+)$", 1)
    files = files.where(((version == "") | version.isin(current)) & ((marker == "") | marker.isin(current)))
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.regexp_extract(F.col("path"), r"^.*?\Q" + base + r"\E/(.*)$", 1)
    return files.select(
        F.col("path"),
        rel.alias("relative_path"),
        F.col("length"),
        F.col("modificationTime").alias("modification_time"),
    )


def layer_row_counts(spark: SparkSession, root: str, layers: Sequence[str]) -> DataFrame:
    """``(layer, rows)``: the rows each data file holds, joined to the
    manifest by path and summed by layer folder. Reads Parquet footers only.
    Rows of a file that the manifest lacks are missing from the sum."""
    listed = lake_manifest(spark, root)
    per_file = None
    for layer in layers:
        one = spark.read.parquet(V.current_path(spark, f"{root}/{layer}")).select(F.col("_metadata.file_path").alias("path"))
        one = one.groupBy("path").agg(F.count("*").alias("rows")).withColumn("layer", F.lit(layer))
        per_file = one if per_file is None else per_file.unionByName(one)
    # the two sources write a local path with one or three slashes
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    both = per_file.withColumn("path", same("path")).join(listed.select(same("path").alias("path")), "path")
    return both.groupBy("layer").agg(F.sum("rows").alias("rows"))
