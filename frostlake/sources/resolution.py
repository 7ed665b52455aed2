"""A source that is missing, empty, unreadable or unreachable gives way to given data.

Which failures do that is the caller's choice; any other failure is raised. Why a source was not used is
recorded. Nothing is written to the source, or over it: the substitute is another DataFrame.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OK, EMPTY, PATH_MISSING, READ_ERROR, UNREACHABLE, TIMEOUT = "ok", "empty", "path_missing", "read_error", "unreachable", "timeout"
FAILURES = (EMPTY, PATH_MISSING, READ_ERROR, UNREACHABLE, TIMEOUT)

# error conditions of the reader; anything else (a wrong column, a wrong type) is the caller's mistake and is raised
_MISSING = {"PATH_NOT_FOUND"}
_NO_FILES = {"UNABLE_TO_INFER_SCHEMA"}
_UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED_RECORD_IN_PARSING")
# what is said when there is no connector for a topic, or no broker answers
_NOBODY = ("DATA_SOURCE_NOT_FOUND", "Failed to find data source", "org.apache.kafka", "UnknownHostException", "ConnectException", "Connection refused")

RESOLUTION_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("resolved_at", T.TimestampType(), False),
        T.StructField("used", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("detail", T.StringType(), True),
        T.StructField("seconds", T.DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class Resolution:
    """What to read (``df``), whether it is the primary source or the fallback, and why."""

    source: str
    df: DataFrame
    used: str
    reason: str
    detail: str | None
    seconds: float

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The record of the decision, one row."""
        row = (self.source, dt.datetime.now(dt.timezone.utc), self.used, self.reason, self.detail, self.seconds)
        return spark.createDataFrame([row], RESOLUTION_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("append").parquet(path)


def classify(error: PySparkException | Py4JJavaError) -> str | None:
    """The kind of a reader's failure, or None if it is another mistake."""
    text = str(error)
    named = re.search(r"\[([A-Z_]+)", text)
    condition = (isinstance(error, PySparkException) and error.getCondition() or (named and named.group(1)) or "").split(".")[0]
    if condition in _MISSING:
        return PATH_MISSING
    if condition in _NO_FILES:
        return EMPTY
    if condition in _UNREADABLE:
        return READ_ERROR
    if any(sign in text for sign in _NOBODY):
        return UNREACHABLE
    return None


def _probe(spark: SparkSession, source: Callable[[], DataFrame], timeout: float) -> tuple[DataFrame | None, str, str | None]:
    sc, tag, late = spark.sparkContext, f"probe-{uuid.uuid4().hex[:8]}", threading.Event()

    def stop() -> None:
        late.set()
        sc.cancelJobsWithTag(tag)

    timer = threading.Timer(timeout, stop)
    interrupt = sc.getLocalProperty("spark.job.interruptOnCancel")
    sc.addJobTag(tag)
    sc.setInterruptOnCancel(True)
    timer.start()
    try:
        df = source()
        return (None, EMPTY, None) if df.isEmpty() else (df, OK, None)
    except (PySparkException, Py4JJavaError) as e:
        reason = TIMEOUT if late.is_set() else classify(e)
        if reason is None:
            raise
        return None, reason, str(e).split("\n")[0][:500]
    finally:
        timer.cancel()
        sc.removeJobTag(tag)
        sc.setLocalProperty("spark.job.interruptOnCancel", interrupt)


def resolve_source(
    spark: SparkSession,
    name: str,
    source: Callable[[], DataFrame],
    fallback: DataFrame,
    on: Sequence[str] = FAILURES,
    timeout: float = 60.0,
) -> Resolution:
    """The source, or ``fallback`` if the source fails in one of the ways of ``on``.

    ``source`` makes the DataFrame (a missing path fails there already). One row of it is then asked for, in at most
    ``timeout`` seconds: the probe's jobs are cancelled after that. Rows beyond the first are not looked at, so
    a file that cannot be read may still fail later; that failure is raised where it happens, as no result of part of
    the source must be mixed with the fallback. A failure that ``on`` does not list is raised.
    """
    unknown = set(on) - set(FAILURES)
    if unknown:
        raise ValueError(f"no such failures: {sorted(unknown)}")
    started = time.time()
    df, reason, detail = _probe(spark, source, timeout)
    seconds = time.time() - started
    if df is not None:
        return Resolution(name, df, "primary", reason, None, seconds)
    if reason not in on:
        raise SourceFailed(name, reason, detail)
    return Resolution(name, fallback, "fallback", reason, detail, seconds)


class SourceFailed(RuntimeError):
    """A source failed in a way that the caller did not allow to be replaced."""

    def __init__(self, source: str, reason: str, detail: str | None):
        super().__init__(f"source {source!r} failed: {reason}" + (f" ({detail})" if detail else ""))
        self.source, self.reason, self.detail = source, reason, detail
