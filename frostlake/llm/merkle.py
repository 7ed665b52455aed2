"""Merkle dataset manifest: a content-addressed DAG over the rows of a table, and proofs by descent.

Leaves are row digests in order of their ids, one tree per group and one tree over the groups' roots. Each
inner node is stored as a record from its digest to its children's digests, and nothing else: a proof starts at
the root's digest and looks up record after record, taking the child that the next digit of the leaf's rank names
and collecting the children not taken. The collected segments, reversed, lead from the leaf to the root.

Requests that share leading digits descend together: a level's lookups are as many as the distinct prefixes
that are asked for, and the paths are spread to single leaves in the last step only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostlake.llm.common import materialize
from frostlake.llm.ordering import ordered, ranked
from frostlake.session import scratch_path

#: Children of a node.
FAN = 8
_BITS = 3

_PATH = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text, 256)


def encoded(column: Column) -> Column:
    """The value's text with its length in bytes before it, ``-`` for null: no two rows give the same concatenation."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


@dataclass
class Forest:
    """Trees over the nodes of numbered groups. ``tops``: (grp, n, height, digest) of each tree; ``levels[k]``: the
    records (digest, children) of the nodes of height k + 1."""

    tops: DataFrame
    levels: list[DataFrame]


def build(nodes: DataFrame, folder: str | None = None) -> Forest:
    """The forest over written ``nodes`` (grp, n, rank, digest): ranks from 0 to n - 1 in each group.

    Records are written under ``folder`` (a new scratch folder by default), a folder for each height.
    """
    spark = nodes.sparkSession
    folder = folder or scratch_path(spark, "manifest")
    most = nodes.agg(F.max("n")).first()[0] or 1
    nodes = nodes.select("grp", "n", F.col("n").alias("left"), "rank", "digest")
    lone, levels = lambda height: nodes.where("left = 1").select("grp", "n", F.lit(height).alias("height"), "digest"), []
    tops = lone(0)
    while most > 1:
        runs = nodes.where("left > 1").groupBy("grp", "n", F.ceil(F.col("left") / FAN).alias("left"), F.shiftright("rank", _BITS).alias("rank"))
        # at most FAN children in a group
        children = F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda c: c["digest"])
        level = runs.agg(children.alias("children")).withColumn("digest", digest(F.array_join("children", "")))
        path = f"{folder}/height={len(levels) + 1}"
        level.write.parquet(path)
        stored = spark.read.schema(level.schema).parquet(path)
        # equal digests are equal records
        levels.append(stored.groupBy("digest").agg(F.first("children").alias("children")))
        nodes, most = stored.select("grp", "n", "left", "rank", "digest"), -(-most // FAN)
        tops = tops.union(lone(len(levels)))
    return Forest(materialize(tops, "tops"), levels)


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (grp, rank and other columns) with ``path``: what was not taken on the way down to that leaf.

    ``starts`` (grp, path) says how each tree's top was reached. A path has a segment for each level, from
    the root on: the digests of the children before and after the one taken, each concatenated. A rank or
    group that the forest does not have gives no row.
    """
    height = len(forest.levels)
    wanted = [requests]
    for _ in range(height - 1):
        wanted.append(materialize(wanted[-1].select("grp", F.shiftright("rank", _BITS).alias("rank")).distinct(), "wanted"))
    tops = forest.tops.select("grp", "height", "digest")
    starts = materialize(starts.join(tops, "grp").select("grp", "height", F.lit(0).cast("long").alias("_prefix"), "digest", "path"), "starts")
    at_height = lambda k: starts.where(F.col("height") == k).drop("height")
    segment = F.struct(
        F.array_join(F.expr("slice(children, 1, digit)"), "").alias("before"),
        F.array_join(F.expr(f"slice(children, digit + 2, {FAN})"), "").alias("after"),
    )
    here = at_height(height)
    for k in range(height, 0, -1):
        records = here.join(forest.levels[k - 1], "digest").drop("digest")
        asked = wanted[k - 1].withColumn("_prefix", F.shiftright("rank", _BITS)).withColumn("digit", F.col("rank").bitwiseAND(F.lit(FAN - 1)).cast("int"))
        found = asked.join(records, ["grp", "_prefix"]).where(F.col("digit") < F.size("children"))
        path = F.concat("path", F.array(segment)).cast(_PATH).alias("path")
        if k == 1:
            lone = requests.where("rank = 0").join(at_height(0).select("grp", "path"), "grp")
            return found.select(*requests.columns, path).union(lone.select(*requests.columns, "path"))
        below = found.select("grp", F.col("rank").alias("_prefix"), F.get("children", "digit").alias("digest"), path)
        here = materialize(below.union(at_height(k - 1).select(*below.columns)), "descent")
    return requests.where("rank = 0").join(here.select("grp", "path"), "grp").select(*requests.columns, "path")


def proof(path: Column) -> Column:
    """The digests that the descent left aside, from the leaf's run up to the root's, left to right."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["before"], s["after"])), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root digest that a leaf's digest leads to along the reversed path."""
    return F.aggregate(F.reverse(path), leaf, lambda h, s: digest(F.concat(s["before"], h, s["after"])))


def manifest(rows: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", claims: dict[str, Column] | None = None, folder: str | None = None) -> DataFrame:
    """One row per row: (id, group, leaf, subroot, root, path, claimed, folded_root, verified).

    A leaf is the digest of the row's ``fields``, in that order, as ``encoded``. Leaves of a group ascend by id (null
    first), ties by leaf; groups ascend bytewise (null first, a group like others). ``path`` is the descent from the
    root to the leaf as segments (before, after); ``claimed`` is the leaf of the row with the columns of ``claims``
    (field -> expression) in place of its own; ``folded_root`` is the root that ``claimed`` leads to along the original
    siblings, and ``verified`` says whether that is the root.

    Rows repeated whole are leaves of their own. A lone leaf is its group's subroot, a lone group's subroot the
    root. An empty table gives no rows; columns other than fields, id and group are not read.
    """
    leaf = digest(F.concat(*[encoded(rows[f"`{f}`"]) for f in fields]))
    claimed = digest(F.concat(*[encoded((claims or {}).get(f, rows[f"`{f}`"])) for f in fields]))
    leaves = rows.select(rows[f"`{id_col}`"].alias("id"), rows[f"`{group_col}`"].alias("key"), leaf.alias("digest"), claimed.alias("claimed"))
    first = [F.col("key").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest").asc()]
    leaves = materialize(ranked(ordered(leaves, first, "place", "leaves"), "place", "key").drop("place"), "ranked-leaves")
    low = build(leaves.select("grp", "n", "rank", "digest"), folder and f"{folder}/leaves")

    # the groups' roots are the leaves of the upper tree, in order of the groups
    subroots = low.tops.select(F.col("grp").alias("id"), F.lit(0).alias("key"), F.col("digest"))
    subroots = materialize(ranked(ordered(subroots, [F.col("id").asc()], "place", "subroots"), "place", "key"), "ranked-subroots")
    high = build(subroots.select("grp", "n", "rank", "digest"), folder and f"{folder}/groups")
    top = high.tops.first()
    reached = descend(high, high.tops.select("grp", F.array().cast(_PATH).alias("path")), subroots.select("grp", "rank", "id"))
    reached = materialize(reached.select(F.col("id").alias("grp"), "path"), "group-paths")

    found = descend(low, reached, leaves.drop("n")).join(low.tops.select("grp", F.col("digest").alias("subroot")), "grp")
    return found.select(
        "id", F.col("key").alias("group"), F.col("digest").alias("leaf"), "subroot", F.lit(top and top["digest"]).cast("string").alias("root"),
        "path", "claimed", fold(F.col("path"), F.col("claimed")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
