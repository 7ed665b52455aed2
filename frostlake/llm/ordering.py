"""One order over all rows of a table, without a task that sees them all.

Rows are dealt to ranges of their sort keys, sorted within each, and written with a place: numbers that
grow along the whole order. A place is its range's number (upper bits) and the row's place in that range,
so places of one range follow each other without gaps. What has to be known about neighbours or ranks across
ranges comes from one small row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostlake.llm.common import fresh_name, materialize

#: Bits of a place that count rows within a range.
RANGE_BITS = 33


def ordered(df: DataFrame, order: list[Column], place: str, name: str) -> DataFrame:
    """``df`` with ``place`` (long), written in the given order (sort expressions; rows equal in all of them
    come in any order). Equal rows are split among ranges too: a row number is the last key."""
    salt = fresh_name(df, "_salt")
    dealt = df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*order, F.col(salt))
    dealt = dealt.sortWithinPartitions(*order, salt).drop(salt)
    return materialize(dealt.withColumn(place, F.monotonically_increasing_id()), name, "zstd")


def range_of(place: str) -> Column:
    return F.shiftright(F.col(place), RANGE_BITS)


def followers(placed: DataFrame, place: str) -> DataFrame:
    """(last, following) for every range: the place of its last row, and of the next range's first one (null
    after the last range). One row per range."""
    ends = placed.groupBy(range_of(place).alias("range")).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    return ends.select("last", F.lead("first").over(Window.orderBy("range")).alias("following"))


def ranked(placed: DataFrame, place: str, group: str) -> DataFrame:
    """``placed``, ordered by ``group`` first, with (grp, n, rank): a number of the row's group that grows along
    the order, the group's rows, and the row's rank in it from 0. Groups may be null."""
    spans = placed.groupBy(F.col(group).alias("_g"), range_of(place).alias("_r")).agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    spans = materialize(spans, "spans")
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_g", "_r", "_first", F.min("_first").over(whole).alias("grp"), F.sum("_n").over(whole).alias("n"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col(group).eqNullSafe(F.col("_g")) & (range_of(place) == F.col("_r"))
    return placed.join(spans, same).withColumn("rank", F.col(place) - F.col("_first") + F.col("_before")).drop("_g", "_r", "_first", "_before")
