"""Helpers shared by the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from frostlake.session import checkpoint_root, scratch_path

#: Rows of (long, small payload) that may be broadcast; a side beyond it is joined by shuffle.
BROADCAST_ROWS = 500_000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freed_shuffles(spark: SparkSession):
    """Shuffle files of the enclosed write go when it ends: what follows reads the written table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut there, and a lost
    executor costs no more than a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with _freed_shuffles(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case, as Spark resolves names)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A unique number for each row, so that null and repeated ids need no special case.

    It is the scan's partition and row number, and holds for one scan only: the next may be split
    otherwise, as the splits follow the cores there are at planning time. What is decided by number in one
    scan and applied in another needs ``numbered``.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a unique number for each row, written once: the number is stored beside its row."""
    empty = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
    stored = materialize(with_row_id(df.drop(*empty), name), "rows", "zstd")
    return stored.select(*[F.lit(None).alias(c) if c in empty else stored[f"`{c}`"] for c in df.columns], name)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; df must be written already."""
    return F.broadcast(df) if df.count() <= rows else df


def drop_rows(docs: DataFrame, row_id: str, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with ``row_id``) that ``dropped`` (one column of the same name) does not list."""
    return docs.join(small_enough(dropped), row_id, "left_anti").drop(row_id)


def shared_folder(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b longs): root is the component's smallest node.

    Alternating large-star and small-star rounds. Each round joins every edge to the minimum of
    its neighbourhood. The minima are an aggregate, so a hub is combined map-side, and are written
    first, so that both sides of the join are plain shuffles, of which Spark can split a hub's. Each
    round is written to the shared folder. Loops and repeated edges are ignored.
    """
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        both = links.union(links.select("b", "a")).toDF("u", "v")
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(low, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        links = materialize(small.select("e.a", "e.b").where("a <> b").distinct(), "stars")
