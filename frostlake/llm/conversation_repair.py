"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation has an optional system turn and then user and assistant turns in alternation. Each logged
turn is kept, given another role, or deleted, and empty turns are inserted; edits cost, and the cheapest edits are
sought, of those the ones whose initials, in order, are least. Between two turns the state is one of four: nothing
yet, after system, after user, after assistant.

The cost of the cheapest edits up to a turn is a vector over the four states, and so is the cost from there on. The
two meet in the middle of a conversation: the state in which their sum is least is where the cheapest edits cross.
Both halves then are problems of the same kind, with the state at both ends given, so that no table over all turns is
kept. The forward vector also ranks its states by the initials that lead to them. Inserts count to the turn that follows,
so all these lists have equally many initials other than inserts: none begins another, and their ranks decide ties.

A conversation may hold a third of all rows. Turns are put in one order (see ``ordering``) and cut into segments; a
segment is summed up in a matrix of costs and ranks from each state before it to each state after it. Matrices of
consecutive segments are combined level by level, the crossings are found from the top level down to the
segments, and each segment then solves its own turns.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.llm.common import materialize
from frostlake.llm.ordering import ordered, range_of

#: States between turns.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits, and of a truncated turn that is not deleted.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Inserted turns that end a conversation in each state.
CLOSING = (0, 2, 1, 0)
#: Faults of a turn; the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
#: Turns of a segment, and segments that are combined into one.
SEGMENT_TURNS, FAN = 4096, 256
#: ASCII white space, and what ends a sentence.
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"

# initials: 0 system, 1 user, 2 assistant, 3 another
_LEGAL = {(0, 1), (1, 2), (2, 1)}
# edits of a turn with the inserts before it, in ASCII order
_EDITS = ("D", "IK", "IR", "K", "R")


# ------------------------------------------------------------------ four-state vectors


def _moves(code: int) -> list[list[tuple[int, int] | None]]:
    """[before][after]: (cost, edit's place in _EDITS) of a turn with this code, or None."""
    initial, fault = code % 8, code // 8
    best: list[list[tuple[int, int] | None]] = [[None] * 4 for _ in range(4)]

    def offer(before: int, after: int, cost: int, edit: str) -> None:
        move = (cost, _EDITS.index(edit))
        if best[before][after] is None or move < best[before][after]:
            best[before][after] = move

    for before in range(4):
        # an insert before a deleted turn is never least: it can follow the turn
        offer(before, before, DELETE, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED if fault == CUT_OFF else 0
        if initial == 0 and before == NOTHING:
            offer(before, SYSTEM, extra, "K")
        for inserted in (0, 1):
            state = before if not inserted else (ASSISTANT if before == USER else USER)
            after = ASSISTANT if state == USER else USER
            cost, mark = extra + INSERT * inserted, "I" * inserted
            if initial == (2 if after == ASSISTANT else 1):
                offer(before, after, cost, mark + "K")
            offer(before, after, cost + RELABEL, mark + "R")
    return best


_MOVES = [_moves(code) for code in range(32)]


def _ahead(vector, moves):
    """Forward vector one piece on: (least cost taken off, vector). Entries are (cost, rank) or None."""
    found = [min(((v[0] + m[s][0], v[1], m[s][1]) for v, m in zip(vector, moves) if v and m[s]), default=None) for s in range(4)]
    order = sorted(f[1:] for f in found if f)
    least = min(f[0] for f in found if f)
    return least, tuple(f and (f[0] - least, order.index(f[1:])) for f in found)


def _back(vector, moves):
    """Backward vector one piece earlier: costs or None, the least taken off."""
    found = [min((m[0] + v for m, v in zip(row, vector) if m and v is not None), default=None) for row in moves]
    least = min(f for f in found if f is not None)
    return tuple(f if f is None else f - least for f in found)


@lru_cache(maxsize=1 << 16)
def _turn_ahead(vector, code: int):
    return _ahead(vector, _MOVES[code])


@lru_cache(maxsize=1 << 16)
def _turn_back(vector, code: int):
    return _back(vector, _MOVES[code])


def _at(state: int, value):
    return tuple(value if s == state else None for s in range(4))


def crossings(pieces, before: int, after: int, ahead=_ahead, back=_back) -> list[int]:
    """The state after each piece on the least path from ``before`` to ``after``."""
    states = [after] * len(pieces)

    def halve(low: int, high: int, first: int, last: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        forward, backward = _at(first, (0, 0)), _at(last, 0)
        for i in range(low, middle):
            forward = ahead(forward, pieces[i])[1]
        for i in range(high - 1, middle - 1, -1):
            backward = back(backward, pieces[i])
        met = ((f[0] + b, f[1], s) for s, (f, b) in enumerate(zip(forward, backward)) if f and b is not None)
        state = min(met)[2]
        states[middle - 1] = state
        halve(low, middle, first, state)
        halve(middle, high, state, last)

    halve(0, len(pieces), before, after)
    return states


def _matrix(pieces, ahead=_ahead):
    """[before][after]: (cost, rank) over all pieces, or None."""
    out = []
    for before in range(4):
        vector, cost = _at(before, (0, 0)), 0
        for piece in pieces:
            taken, vector = ahead(vector, piece)
            cost += taken
        out.append(tuple(v and (v[0] + cost, v[1]) for v in vector))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def _summary(codes: bytes):
    """(matrix, faults, first initial, last initial, adjacent initials that are not legal) of turns."""
    initials = [c % 8 for c in codes]
    illegal = sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))
    faults = [sum(c // 8 == f for c in codes) for f in (BLANK, DUPLICATE, CUT_OFF)]
    return _matrix(codes, _turn_ahead), faults, initials[0], initials[-1], illegal


@lru_cache(maxsize=1 << 14)
def _solved(codes: bytes, before: int, after: int) -> tuple[list[str], list[int]]:
    """(edit, state after it) of each turn of a segment."""
    states = crossings(codes, before, after, _turn_ahead, _turn_back)
    return [_EDITS[_MOVES[c][p][s][1]] for c, p, s in zip(codes, [before, *states], states)], states


# ------------------------------------------------------------------ segments


_STATS = "blank long, duplicate long, truncated long, illegal long, first int, last int, costs array<long>, ranks array<int>"


def _packed(matrix):
    flat = [m for row in matrix for m in row]
    return [-1 if m is None else m[0] for m in flat], [-1 if m is None else m[1] for m in flat]


def _unpacked(costs, ranks):
    flat = [None if c < 0 else (c, r) for c, r in zip(costs, ranks)]
    return tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4))


def _frame(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _differs(ids: pa.Array) -> np.ndarray:
    """Whether each id is another than the one before it; null is an id."""
    a, b = ids[1:], ids[:-1]
    same = pc.fill_null(pc.equal(a, b), False)
    return ~np.asarray(pc.or_(same, pc.and_(a.is_null(), b.is_null())), dtype=bool)


def _segments(most: int):
    """Turns (place, conv_id, code) by place -> (conv_id, segment, and what _STATS says), up to ``most`` turns a segment."""

    def run(batches):
        schema, held, done = None, None, []

        def close() -> None:
            conv, first, codes = held
            for at in range(0, len(codes), most):
                matrix, faults, begin, end, illegal = _summary(bytes(codes[at : at + most]))
                done.append((conv, first + at, *faults, illegal, begin, end, *_packed(matrix)))

        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field("conv_id"), pa.field("segment", pa.int64()), *_NUMBERS, *_MATRIX])
            if not batch.num_rows:
                continue
            ids, place, codes = batch.column("conv_id"), batch.column("place").to_numpy(), batch.column("code").to_numpy().astype(np.uint8)
            edges = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | _differs(ids)])
            for start, stop in zip(edges, np.r_[edges[1:], len(place)]):
                conv, piece = ids[start].as_py(), codes[start:stop].tobytes()
                if held and held[0] == conv and held[1] + len(held[2]) == place[start]:
                    held[2].extend(piece)
                    while len(held[2]) > most:
                        rest = held[2][most:]
                        held[2] = held[2][:most]
                        close()
                        held = [conv, held[1] + most, rest]
                    continue
                if held:
                    close()
                held = [conv, int(place[start]), bytearray(piece)]
            if len(done) >= 1000:
                yield _frame(schema, done)
                done = []
        if held:
            close()
        if done:
            yield _frame(schema, done)

    return run


def _families(batches):
    """Rows in runs of equal (conv, node), as lists."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["conv"], held[0]["node"]) != (row["conv"], row["node"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _in_batches(schema: pa.Schema, rows, size: int = 1000):
    ready: list[tuple] = []
    for row in rows:
        ready.append(row)
        if len(ready) >= size:
            yield _frame(schema, ready)
            ready = []
    if ready:
        yield _frame(schema, ready)


_NUMBERS = [pa.field(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
_MATRIX = [pa.field("first", pa.int32()), pa.field("last", pa.int32()), pa.field("costs", pa.list_(pa.int64())), pa.field("ranks", pa.list_(pa.int32()))]


def _combined(batches):
    """Nodes (conv, node, at, stats), sorted so -> one row (conv, node, stats) for each (conv, node)."""

    def joined(rows) -> tuple:
        matrix = _matrix([_unpacked(r["costs"], r["ranks"]) for r in rows])
        sums = [sum(r[f.name] for r in rows) for f in _NUMBERS]
        sums[3] += sum((a["last"], b["first"]) not in _LEGAL for a, b in zip(rows, rows[1:]))
        return (rows[0]["conv"], rows[0]["node"], *sums, rows[0]["first"], rows[-1]["last"], *_packed(matrix))

    schema = pa.schema([("conv", pa.int64()), ("node", pa.int64()), *_NUMBERS, *_MATRIX])
    yield from _in_batches(schema, map(joined, _families(batches)))


def _descended(batches):
    """Nodes (conv, node, at, costs, ranks, before, after), the states those of the node's parent, sorted so ->
    (conv, at, before, after) with each node's own states."""

    def split(rows):
        pieces = [_unpacked(r["costs"], r["ranks"]) for r in rows]
        states = crossings(pieces, rows[0]["before"], rows[0]["after"])
        return [(r["conv"], r["at"], p, s) for r, p, s in zip(rows, [rows[0]["before"], *states], states)]

    schema = pa.schema([("conv", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])
    yield from _in_batches(schema, (row for rows in _families(batches) for row in split(rows)))


def _edited(batches):
    """Turns (place, kind 1, code) behind their segment's states (place, kind 0, before, after) -> (place, edit, state)."""
    schema = pa.schema([("place", pa.int64()), ("edit", pa.string()), ("state", pa.int32())])
    ends, places, codes = None, [], bytearray()

    def solve() -> pa.RecordBatch:
        edits, states = _solved(bytes(codes), *ends)
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(edits, pa.string()), pa.array(states, pa.int32())], schema=schema)

    ready, size = [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("place", "kind", "code", "before", "after")]
        for place, kind, code, before, after in zip(*columns):
            if kind:
                places.append(place)
                codes.append(code)
                continue
            if places:
                ready.append(solve())
                size += len(places)
                if size >= 10_000:
                    yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                    ready, size = [], 0
            ends, places, codes = (before, after), [], bytearray()
    if places:
        ready.append(solve())
    if ready:
        yield from pa.Table.from_batches(ready).combine_chunks().to_batches()


# ------------------------------------------------------------------ the operator


def _coded(turns: DataFrame) -> DataFrame:
    """(place, conv_id, code) of ordered turns: the role's initial (3: another) and the turn's first fault."""
    firsts = turns.where("not blank").groupBy("conv_id", "role", "tie").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    firsts = materialize(firsts.where("n > 1").drop("n"), "first-said")
    t, f = turns.alias("t"), firsts.alias("f")
    same = F.col("t.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("t.role") == F.col("f.role")) & (F.col("t.tie") == F.col("f.tie"))
    said = F.coalesce(F.col("t.place") > F.col("f.first"), F.lit(False))
    fault = F.when(F.col("t.blank"), BLANK).when(said, DUPLICATE).when(F.col("t.cut_off"), CUT_OFF).otherwise(SOUND)
    letter = F.substring("t.role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    return t.join(f, same, "left").select("t.place", "t.conv_id", (initial + 8 * fault).alias("code"))


def _whole(segments: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """Of segments (conv_id, segment, stats): (conv_id, stats, cost, state) for each conversation, and
    (place, before, after) for each segment: the states at its two ends on the least path."""
    stats = [f.name for f in [*_NUMBERS, *_MATRIX]]
    convs = segments.groupBy("conv_id").agg(F.min("segment").alias("conv"), F.count("*").alias("parts"))
    s, c = segments.alias("s"), convs.alias("c")
    known = materialize(s.join(c, F.col("s.conv_id").eqNullSafe(F.col("c.conv_id"))).select("s.*", "c.conv", "c.parts"), "segments-of")
    single, several = known.where("parts = 1"), known.where("parts > 1")

    # a segment's number in its conversation, counted range by range
    spans = several.groupBy("conv", range_of("segment").alias("range")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv", "range").orderBy("segment"))
    several = several.withColumn("range", range_of("segment")).withColumn("inside", inside).join(spans, ["conv", "range"])
    levels = [materialize(several.select("conv", (F.col("before") + F.col("inside") - 1).alias("at"), "segment", "conv_id", *stats), "level")]
    parent = F.floor(F.col("at") / fan).cast("long").alias("node")
    families = lambda df: df.repartition("conv", "node").sortWithinPartitions("conv", "node", "at")
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:
        up = families(levels[-1].select("conv", parent, "at", *stats)).mapInArrow(_combined, f"conv long, node long, {_STATS}")
        levels.append(materialize(up.withColumnRenamed("node", "at"), "level"))

    names = levels[0].where("at = 0").select("conv", "conv_id")
    tops = single.select("conv", "conv_id", *stats).union(levels[-1].select("conv", *stats).join(names, "conv").select("conv", "conv_id", *stats))
    ends = [F.struct((F.get("costs", s) + INSERT * CLOSING[s]).alias("cost"), F.get("ranks", s).alias("rank"), F.lit(s).alias("state"), F.get("costs", s).alias("open")) for s in range(4)]
    least = F.array_min(F.filter(F.array(*ends), lambda e: e["open"] >= 0))
    tops = materialize(tops.withColumn("least", least).select("conv", "conv_id", *stats, "least.cost", "least.state"), "conversations")

    states = tops.select("conv", F.lit(0).cast("long").alias("at"), F.lit(NOTHING).alias("before"), F.col("state").alias("after"))
    for level in reversed(levels[:-1]):
        asked = level.select("conv", parent, "at", "costs", "ranks").join(states.withColumnRenamed("at", "node"), ["conv", "node"])
        found = families(asked).mapInArrow(_descended, "conv long, at long, before int, after int")
        states = materialize(found, "states")
    found = levels[0].join(states, ["conv", "at"]).select(F.col("segment").alias("place"), "before", "after")
    alone = single.join(tops.select("conv", "state"), "conv").select("conv", F.lit(NOTHING), F.col("state"))
    return tops.select("conv_id", *stats, "cost", "state"), found.union(alone)


def repair_conversations(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment_turns: int = SEGMENT_TURNS, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(steps, overview) of the least repair of each conversation.

    ``steps`` has the edits in order: (conv_id, place, step, edit, role, text), sorted by place and step. An edit is K (kept), R
    (given the other role), D (deleted, text null) or I (an empty turn inserted); the repaired conversation is what is not
    D. ``overview`` has a row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost): turn numbers
    missing between the least and the greatest, turns by their first fault, neighbours whose roles cannot follow
    each other, and the least cost.

    Turns go by number (null first), ties by role and the text's SHA-256. A null role or text is one space. A turn is blank
    if its text has nothing but white space, a duplicate if role and text came earlier, truncated if its last character
    that is not white space ends no sentence. Roles are told by their first character. A null id is an id like others.
    An empty table gives no rows; other columns are not read.
    """
    blank = lambda c: F.coalesce(conversations[f"`{c}`"].cast("string"), F.lit(" "))
    turns = conversations.select(conversations[f"`{id_col}`"].alias("conv_id"), conversations[f"`{turn_col}`"].cast("long").alias("turn"), blank(role_col).alias("role"), blank(text_col).alias("text"))
    said = F.expr(f"trim(TRAILING '{WHITE}' FROM text)")
    turns = turns.withColumns({"tie": F.sha2("text", 256), "blank": said == "", "cut_off": ~F.right(said, F.lit(1)).isin(*ENDS)})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("tie").asc()]
    turns = ordered(turns, order, "place", "turns")

    codes = materialize(_coded(turns), "turn-codes")
    in_order = lambda df, *keys: df.repartition(range_of("place")).sortWithinPartitions(*keys)
    id_type = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("segment", T.LongType()), *T.StructType.fromDDL(_STATS)])
    segments = materialize(in_order(codes, "place").mapInArrow(_segments(segment_turns), id_type), "segments")
    whole, states = _whole(segments, fan)

    heads = states.select("place", F.lit(0).alias("kind"), F.lit(0).alias("code"), "before", "after")
    rows = codes.select("place", F.lit(1).alias("kind"), "code", F.lit(0), F.lit(0))
    edits = materialize(in_order(heads.union(rows), "place", "kind").mapInArrow(_edited, "place long, edit string, state int"), "edits")

    named = lambda state: F.when(state == USER, F.lit("user")).otherwise(F.lit("assistant"))
    kind, text = F.right("edit", F.lit(1)), F.lit("").alias("text")
    before = F.struct(F.lit(0).alias("step"), F.lit("I").alias("edit"), F.when(F.col("state") == USER, F.lit("assistant")).otherwise(F.lit("user")).alias("role"), text)
    own = F.struct(F.lit(1).alias("step"), kind.alias("edit"), F.when(kind == "R", named(F.col("state"))).otherwise(F.col("role")).alias("role"), F.when(kind != "D", F.col("text")).alias("text"))
    steps = turns.select("place", "conv_id", "role", "text").join(edits, "place")
    steps = steps.select("conv_id", "place", F.inline(F.when(F.startswith("edit", F.lit("I")), F.array(before, own)).otherwise(F.array(own))))
    # what ends a conversation comes after all its places
    user, assistant = (F.struct(F.lit(i).alias("step"), F.lit("I").alias("edit"), F.lit(r).alias("role"), text) for i, r in ((2, "user"), (3, "assistant")))
    ends = whole.select("conv_id", F.lit((1 << 63) - 1).alias("place"), F.inline(F.when(F.col("state") == SYSTEM, F.array(user, assistant)).when(F.col("state") == USER, F.array(assistant))))

    numbers = turns.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id")
    numbers = numbers.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    w, n = whole.alias("w"), numbers.alias("n")
    overview = w.join(n, F.col("w.conv_id").eqNullSafe(F.col("n.conv_id")), "left")
    overview = overview.select("w.conv_id", F.coalesce("n.gaps", F.lit(0)).cast("long").alias("gaps"), "w.blank", "w.duplicate", "w.truncated", "w.illegal", "w.cost")
    return steps.union(ends), overview


def _read_out(batches):
    """Steps by (conv_id, place, step) -> (conv_id, audit, repaired_sha256): one pass, a turn at a time."""
    schema, done, held, audit, digest, fresh = None, [], None, [], None, True
    for batch in batches:
        if schema is None:
            schema = pa.schema([batch.schema.field("conv_id"), pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
        if not batch.num_rows:
            continue
        begins = np.r_[True, _differs(batch.column("conv_id"))]
        for i, (conv, edit, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text")))):
            if digest is None or (begins[i] and (i > 0 or conv != held)):
                if digest is not None:
                    done.append((held, "".join(audit), digest.hexdigest()))
                held, audit, digest, fresh = conv, [], hashlib.sha256(), True
            audit.append(edit)
            if edit != "D":
                digest.update(("" if fresh else "\n").encode() + f"{role}:{text}".encode())
                fresh = False
        if len(done) >= 1000:
            yield _frame(schema, done)
            done = []
    if digest is not None:
        yield _frame(schema, [*done, (held, "".join(audit), digest.hexdigest())])


def read_out(steps: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the initials of a conversation's edits, and the digest of its repaired
    ``role:text``, joined by line feeds. A digest has to read its conversation in order: one task streams it and
    holds no more than a batch of turns and the initials."""
    out = T.StructType([steps.schema["conv_id"], *T.StructType.fromDDL("audit string, repaired_sha256 string")])
    dealt = steps.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    return dealt.select("conv_id", "edit", "role", "text").mapInArrow(_read_out, out)
