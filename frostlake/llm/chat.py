"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

A logged conversation is often a snapshot of one that went on. Each turn gets a hash of its place and
content; the running exclusive-or of these along a conversation is the hash of each of its prefixes. A
conversation is a snapshot if a longer one has its whole hash as a prefix hash: an anti-join drops it.

A conversation may hold a third of all rows, so its turns are numbered and its hashes accumulated in
blocks of turn numbers: first within the block, then over the few block totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostlake.llm.common import materialize

#: Turn numbers of a block.
BLOCK_TURNS = 1000


def _offsets(totals: DataFrame, column: str, combine) -> DataFrame:
    """For each (conv_id, block), ``column`` combined over the conversation's earlier blocks."""
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(combine(column).over(before), F.lit(0).cast("long"))).drop(column)


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with (place, p1, p2): its place from 0 and the hash of the
    conversation up to and with it. Rows repeated whole are one turn."""
    turns = turns.distinct().withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS).cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    counted = turns.withColumn("rank", F.row_number().over(inside) - 1)
    offsets = _offsets(turns.groupBy("conv_id", "block").agg(F.count("*").alias("n")), "n", F.sum)
    same = F.col("t.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("t.block") == F.col("o.block"))
    placed = counted.alias("t").join(offsets.alias("o"), same).select("t.*", (F.col("o.before") + F.col("t.rank")).alias("place")).drop("rank")
    content = [F.col("place"), F.coalesce("role", F.lit("\x00")), F.coalesce("text", F.lit("\x00"))]
    placed = placed.withColumn("h1", F.xxhash64(F.lit(1), *content)).withColumn("h2", F.xxhash64(F.lit(2), *content))
    placed = materialize(placed, "turns")
    running = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed
    for h, p in (("h1", "p1"), ("h2", "p2")):
        before = _offsets(placed.groupBy("conv_id", "block").agg(F.bit_xor(h).alias(h)), h, F.bit_xor)
        same = F.col("t.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("t.block") == F.col("o.block"))
        out = out.withColumn(p, F.bit_xor(h).over(running))
        out = out.alias("t").join(before.alias("o"), same).select(*[F.col(f"t.{c}") for c in out.columns if c != p], F.col(f"t.{p}").bitwiseXOR(F.col("o.before")).alias(p))
    return out.drop("h1", "h2", "block")


def maximal(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with prefix hashes, conversations that stay): the second as (conv_id, n_turns, n_logged).

    Of equal conversations the smallest id stays (null last); n_logged counts the equal ones. One that
    is a proper prefix of another goes.
    """
    steps = materialize(prefixes(turns), "prefixes")
    sizes = steps.groupBy("conv_id").agg(F.max("place").alias("last"))
    whole = steps.alias("s").join(sizes.alias("z"), F.col("s.conv_id").eqNullSafe(F.col("z.conv_id")) & (F.col("s.place") == F.col("z.last"))).select("s.conv_id", "s.place", "s.p1", "s.p2")
    # equal conversations and equal prefixes are combined before anything is joined
    best = F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("best")
    ends = whole.groupBy("place", "p1", "p2").agg(best, F.count("*").alias("n_logged"))
    inner = steps.alias("s").join(sizes.alias("z"), F.col("s.conv_id").eqNullSafe(F.col("z.conv_id")) & (F.col("s.place") < F.col("z.last"))).select("s.place", "s.p1", "s.p2").distinct()
    stay = ends.join(inner, ["place", "p1", "p2"], "left_anti")
    return steps, stay.select(F.col("best.conv_id").alias("conv_id"), (F.col("place") + 1).alias("n_turns"), "n_logged")


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rendered turns of the maximal conversations: (conv_id, place, n_turns, n_logged, rendered).

    Turns go by number (null first), ties by role and text; rows repeated whole count once. A
    conversation equal to another, or a proper prefix of one, is not rendered. Each turn is rendered
    as a row of its own, so a conversation of any length streams: its text is the concatenation by
    place. A null role is rendered as "user", a null text as empty, and the frame's own marks inside a
    text are broken by a space. A null conversation id is an id like others. An empty table gives no
    rows; other columns are not read.
    """
    turns = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    steps, stay = maximal(turns)
    safe = F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1|>")
    shown = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("user")), F.lit("\n"), safe, F.lit("<|im_end|>\n"))
    kept = steps.alias("s").join(materialize(stay, "maximal").alias("m"), F.col("s.conv_id").eqNullSafe(F.col("m.conv_id")))
    return kept.select("s.conv_id", "s.place", "m.n_turns", "m.n_logged", shown.alias("rendered"))
