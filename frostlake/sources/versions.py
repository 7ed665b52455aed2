"""Versions of a layer: whole snapshots side by side, and markers that say which of them count.

A layer's folder holds one folder per version and, in ``_commits``, an empty marker file per committed version. The
current version is the committed one of the greatest name; names begin with a number that grows. Creating an empty
file is one atomic step on any file system, so that a layer changes from one whole snapshot to the next:

* a write that fails, or is killed, leaves a folder without a marker, which no reader looks at;
* a reader resolves the layer once and reads that version's files, whatever is written meanwhile;
* the version before the current one is kept for readers that began on it; older ones go after a commit.

A layer written without versions (files right in its folder) is read as it is. The next write is its first version,
and its files go after that version is committed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from frostlake.session import hadoop_fs

COMMITS = "_commits"
#: Versions that stay readable after a commit, the new one among them.
KEEP = 2

_VERSION = re.compile(r"^v(\d{10})-[0-9a-f]{8}$")
#: The same for Spark's regular expressions, as a folder within a path.
VERSION_IN_PATH = r"/(v\d{10}-[0-9a-f]{8})/"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def committed(spark: SparkSession, layer: str) -> list[str]:
    """Names of the layer's committed versions, the current one last (metadata only)."""
    return [n for n in _names(spark, f"{layer.rstrip('/')}/{COMMITS}") if _VERSION.match(n)]


def current_path(spark: SparkSession, layer: str) -> str:
    """The folder to read a layer from: its current version, or the layer's own folder if it has no versions."""
    versions = committed(spark, layer)
    return f"{layer.rstrip('/')}/{versions[-1]}" if versions else layer


def has_data(spark: SparkSession, layer: str) -> bool:
    """Whether there is something to read: a committed version, or files outside any version."""
    return bool(committed(spark, layer)) or bool(_unversioned(spark, layer))


def _unversioned(spark: SparkSession, layer: str) -> list[str]:
    return [n for n in _names(spark, layer) if n != COMMITS and not _VERSION.match(n)]


def new_version(spark: SparkSession, layer: str) -> str:
    """Name of a version after all that are there, committed or not; no other writer has the same."""
    taken = [int(m.group(1)) for n in [*_names(spark, layer), *committed(spark, layer)] if (m := _VERSION.match(n))]
    return f"v{max(taken, default=0) + 1:010d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, layer: str, version: str, keep: int = KEEP) -> None:
    """Make a written version the current one, then remove what no reader can need.

    A version whose folder is gone (removed by a later writer's commit) cannot be committed.
    """
    layer = layer.rstrip("/")
    fs, folder = hadoop_fs(spark, f"{layer}/{version}")
    if not fs.exists(folder):
        raise RuntimeError(f"version {version} of {layer} is gone: a later version was committed meanwhile")
    before = _unversioned(spark, layer)
    if not fs.createNewFile(hadoop_fs(spark, f"{layer}/{COMMITS}/{version}")[1]):
        raise RuntimeError(f"version {version} of {layer} was committed before")
    _retire(spark, layer, keep, before)


def _retire(spark: SparkSession, layer: str, keep: int, unversioned: list[str]) -> None:
    versions = committed(spark, layer)
    kept = versions[-max(keep, 1) :]
    # a marker goes before its folder: what is marked is there
    for old in versions[: -len(kept)]:
        _delete(spark, f"{layer}/{COMMITS}/{old}")
    # folders before the oldest kept version are retired, or unfinished and too late to count
    for name in _names(spark, layer):
        if _VERSION.match(name) and name not in kept and name < kept[0]:
            _delete(spark, f"{layer}/{name}")
    for name in unversioned:
        _delete(spark, f"{layer}/{name}")
