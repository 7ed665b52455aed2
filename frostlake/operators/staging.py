"""Staging layer: drop unusable readings, then exact duplicates.

Both steps run on the raw *text*, before any cast, so ``'40.0'`` and
``'40.00'`` are different readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostlake.schema import CRITICAL_COLUMNS
from frostlake.sinks.files import materialize


def fresh_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def drop_missing_critical(df: DataFrame, subset: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """drop a reading if any of the critical columns is null.

    Written as a conjunction of ``IS NOT NULL`` (same result as
    ``dropna(how="any")``) so the scan receives it as pushed filters.
    """
    cond = None
    for c in subset:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """keep one copy of rows that are equal in every column.

    Planned as a hash aggregate over all columns: a partial aggregate removes
    copies inside each input split before the shuffle, so a reading repeated
    millions of times (a hot group) ships once per split, not once per copy.
    """
    return df.dropDuplicates()


def drop_exact_duplicates_by_digest(df: DataFrame, max_repeated: int = 4_000_000) -> DataFrame:
    """F2 in two phases: the same rows, but only repeated readings are shuffled whole.

    First a narrow pass shuffles one 8-byte digest per reading and split, and finds the digests that occur twice. Then
    readings with such a digest are compared by all columns, as ``drop_exact_duplicates`` does; all others stay where
    they lie. Readings that only share a digest are told apart by that comparison. The input is read twice, so it should
    be a stored layer.

    The repeated digests are written once and broadcast, 8 bytes each, if there are at most ``max_repeated``; beyond,
    the one-phase form runs.
    """
    digest = fresh_name(df.columns, "_digest")
    digests = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias(digest))
    repeated, _ = materialize(digests.groupBy(digest).count().where("count > 1").select(digest), "repeated-digests")
    if repeated.count() > max_repeated:
        return drop_exact_duplicates(df)
    keyed = df.withColumn(digest, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    once = keyed.join(F.broadcast(repeated), digest, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    suspects = keyed.join(F.broadcast(repeated), digest, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return once.unionByName(drop_exact_duplicates(suspects))


def staging(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """F1 then F2 (the staging layer), F2 in one phase or in two."""
    drop = drop_exact_duplicates_by_digest if by_digest else drop_exact_duplicates
    return drop(drop_missing_critical(df))
