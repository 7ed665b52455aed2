"""Conversation repair against a plain forward search that keeps whole edit lists."""

from __future__ import annotations

import hashlib
import random
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frostlake.llm import conversation_repair as CR
from frostlake.llm.conversation_repair import read_out, repair_conversations

SCHEMA = "conv_id string, turn long, role string, text string, place string, conv int, step int, tie string, n int"
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.rstrip(WHITE)
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired) by a search over all ways, kept whole."""
    ways = {"": (0, "", [])}

    def offer(found, state, way):
        if state not in found or way[:2] < found[state][:2]:
            found[state] = way

    def follow(state, initial):
        if initial == "s":
            return "s" if state == "" else None
        if initial == "u":
            return "u" if state in ("", "s", "a") else None
        return "a" if initial == "a" and state == "u" else None

    def closed(ways):
        for _ in range(3):
            for state, (c, a, r) in list(ways.items()):
                for who in ("user", "assistant"):
                    if follow(state, who[0]):
                        offer(ways, follow(state, who[0]), (c + 3, a + "I", [*r, f"{who}:"]))
        return ways

    for (role, text), fault in zip(rows, faults(rows)):
        found: dict = {}
        for state, (c, a, r) in closed(dict(ways)).items():
            offer(found, state, (c + 4, a + "D", r))
            if fault in (1, 2):
                continue
            extra = 3 * (fault == 3)
            if nxt := follow(state, role[:1]):
                offer(found, nxt, (c + extra, a + "K", [*r, f"{role}:{text}"]))
            for who in ("user", "assistant"):
                if nxt := follow(state, who[0]):
                    offer(found, nxt, (c + extra + 3, a + "R", [*r, f"{who}:{text}"]))
        ways = found
    ends = closed(dict(ways))
    return min((ends[s][:2], ends[s][2]) for s in ("", "a") if s in ends)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, role or " " if role is None else role, " " if text is None else text) for c, t, role, text in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        said = [r[1:] for r in own]
        (cost, audit), repaired = plain_repair(said)
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        f = faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out[conv] = (gaps, f.count(1), f.count(2), f.count(3), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "p", 1, 2, "t", 3) for r in rows], SCHEMA).repartition(7)
    steps, overview = repair_conversations(df, **options)
    texts = {r.conv_id: (r.audit, r.repaired_sha256) for r in read_out(steps).collect()}
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, *texts[r.conv_id]) for r in overview.collect()}
    assert got == expected(rows) and len(texts) == len(got)


def corpus(seed, sizes):
    r = random.Random(seed)
    texts = ["Hello.", "Why?", "cut off", "Yes! ", "", " \n", "one.", "two.", "three", "x" * 70_000 + ".", "Ünder. ", ".\t"]
    rows = []
    for k, size in enumerate(sizes):
        for t in range(size):
            role = r.choices(["user" if t % 2 == 0 else "assistant", "system", "tool", "user", None, ""], [12, 1, 1, 1, 1, 1])[0]
            text = r.choice(texts) if r.random() < 0.5 else f"turn {t}{r.choice(['.', '?', ''])}"
            rows.append((f"c{k}", t if r.random() < 0.95 else None, role, text))
    return rows + r.sample(rows, len(rows) // 8)


def test_many_small_conversations(spark):
    check(spark, [*corpus(1, [random.Random(9).randint(1, 9) for _ in range(60)]), (None, 1, "user", "no id."), (None, None, None, None)])


@pytest.mark.parametrize("segment_turns,fan", [(5, 3), (1, 2), (4096, 256)])
def test_a_long_conversation_is_cut_and_combined(spark, segment_turns, fan):
    check(spark, corpus(segment_turns, [230, 3, 41]), segment_turns=segment_turns, fan=fan)


def test_rows_repeated_whole(spark):
    check(spark, [("c", 1, "user", "same.")] * 90 + [("c", 2, "assistant", "same.")] * 40 + [("d", None, "system", "only.")], segment_turns=7, fan=2)


def test_empty_table(spark):
    steps, overview = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert steps.collect() == [] and overview.collect() == [] and read_out(steps).collect() == []


CODES = [i + 8 * f for i, f in product(range(4), range(4))]


def plain_audit(codes):
    rows, seen = [], 0
    for c in codes:
        role = ["system", "user", "assistant", "tool"][c % 8]
        if c // 8 == 2 and not rows:
            c = c % 8
        seen += 1
        rows.append((role, {0: f"{seen}.", 1: "", 3: f"{seen}"}.get(c // 8, None)))
    return rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([c for c in CODES if c // 8 != 2]), min_size=1, max_size=14))
def test_halving_gives_the_least_edits(codes):
    """Cost and initials of one segment, without Spark."""
    (cost, audit), _ = plain_repair(plain_audit(codes))
    matrix = CR._matrix(bytes(codes), CR._turn_ahead)
    total, _, state = min((m[0] + 3 * CR.CLOSING[s], m[1], s) for s, m in enumerate(matrix[0]) if m)
    edits, _ = CR._solved(bytes(codes), 0, state)
    assert (total, "".join(edits) + "I" * CR.CLOSING[state]) == (cost, audit)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(CODES), min_size=2, max_size=30), st.integers(2, 5))
def test_matrices_of_pieces_combine(codes, size):
    codes = bytes(codes)
    pieces = [CR._matrix(codes[i : i + size], CR._turn_ahead) for i in range(0, len(codes), size)]
    whole = CR._matrix(codes, CR._turn_ahead)
    assert CR._matrix(pieces) == whole
    for after, m in enumerate(whole[0]):
        if m:
            states = CR.crossings(pieces, 0, after)
            edits = [e for i, (p, s) in enumerate(zip([0, *states], states)) for e in CR._solved(codes[i * size : (i + 1) * size], p, s)[0]]
            assert edits == CR._solved(codes, 0, after)[0]
