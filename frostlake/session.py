"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every frostlake session wants. AQE re-plans shuffles and skewed
# joins at runtime; UTC keeps date/hour derivations reproducible.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "frostlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with frostlake's defaults.

    On a cluster, leave ``master`` as None so spark-submit decides, and let the
    cluster set ``spark.checkpoint.dir`` to a shared folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def app_id(spark: SparkSession) -> str:
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # noqa: BLE001
        sc = _context(spark)
        return sc.applicationId if sc is not None else str(id(spark))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and scratch tables.

    Reads ``spark.checkpoint.dir`` from the session (what a cluster sets to a
    shared file system). Only when it is unset on a ``local`` master - local
    runs and tests - a fresh local folder is created and registered; on a
    cluster an unset folder is an error, since executors on other machines
    could not see a driver-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: set it to a folder on shared storage "
                "(e.g. hdfs:// or s3a://) for checkpoints, stream state and intermediate tables"
            )
        root = tempfile.mkdtemp(prefix="frostlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """The file system that Spark itself would use for ``path``: one without a
    scheme belongs to ``fs.defaultFS``, never to the driver's own disk."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only; [] if missing)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` (used to retire old stream snapshots)."""
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def path_size_bytes(spark: SparkSession, path: str) -> int | None:
    """Total bytes under ``path`` from file-system metadata (no data read);
    None if it is missing."""
    fs, p = hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else None


def shuffle_partitions_for(
    spark: SparkSession, input_path: str, bytes_per_partition: int = 256 * 1024 * 1024, expansion: float = 3.0
) -> int:
    """Shuffle width for a full-data shuffle of the table at ``input_path``.

    Columnar input expands when rows are shuffled (``expansion``); aim for
    ``bytes_per_partition`` of shuffle data per reducer. Never below the
    session's ``spark.sql.shuffle.partitions``; AQE coalesces what is small.
    """
    default = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    size = path_size_bytes(spark, input_path)
    if not size:
        return default
    return max(default, -(-int(size * expansion) // bytes_per_partition))
