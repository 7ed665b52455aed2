"""Document fingerprints against a plain SimHash and all-pairs Hamming distances."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from frostlake.llm.common import materialize
from frostlake.llm.fingerprints import MAX_WEIGHT, document_fingerprints, edited_fingerprints, near_pairs

SCHEMA = "doc_id long, text string, place string, range int, fp int, kind string, _row int"
WORDS = "the of and tree River stone cloud light small wind field walk seven Ünder naïve 日本".split()


def h64(text, seed):
    return xxhash.xxh64_intdigest(text.encode(), seed)


def simhash(text):
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower()) if w]
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        h = h64(a, 42) if b is None else h64(b, h64(a, 42))
        w = min(len(a) + len(b or ""), MAX_WEIGHT)
        total += w
        votes = [v + w * (h >> i & 1) for i, v in enumerate(votes)]
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > total)


def corpus(seed, n=120):
    r = random.Random(seed)
    base = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 80))) for _ in range(n // 3)]
    rows = []
    for i in range(n):
        text = r.choice(base)
        if r.random() < 0.4:
            at = r.randrange(len(text) + 1)
            text = text[:at] + r.choice([" wind", "!", "x"]) + text[at:]
        rows.append((i * 7 % 1000, text))
    rows += [(None, "no id"), (None, None), (2000, None), (2001, ""), (2002, " \t!"), (2003, "word " * 20_000), (5, "tie"), (5, "tie two"), (5, "tie")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", 1, 2, "k", 3) for i, t in rows], SCHEMA).repartition(6)


def near(a, b):
    return 1 - (a ^ b).bit_count() / 64


@pytest.mark.parametrize("rows", [corpus(1), [(4, "lone text here")], [(1, "aaaa"), (2, "b")], []], ids=["many", "one", "two", "none"])
def test_edited_fingerprints(spark, rows):
    got = edited_fingerprints(frame(spark, rows), radius=3).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    texts = [t or "" for _, t in order]
    fps = [simhash(t) for t in texts]
    want = []
    for k, (i, _) in enumerate(order):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        same = [j for (j, _), fp in zip(order, fps) if fp == fps[k] and j is not None]
        links = sum((fp ^ fps[k]).bit_count() <= 3 for fp in fps) - 1
        e = simhash(edited)
        class_id = min(same) if same else None
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{fps[k]:016x}", f"{e:016x}", near(fps[k], e), near(fps[k], simhash(after)), class_id, links))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_document_fingerprints_equal_those_beside_edits(spark):
    docs = frame(spark, corpus(2))
    cols = ["doc_id", "fingerprint", "class_id", "n_near"]
    key = lambda r: tuple(map(str, r))
    a = sorted(map(tuple, document_fingerprints(docs, radius=2).select(cols).collect()), key=key)
    b = sorted(map(tuple, edited_fingerprints(docs, radius=2).select(cols).collect()), key=key)
    assert a == b and len(a) == docs.count()


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("split_at", [1000, 3])
def test_tables_find_all_pairs(spark, radius, split_at):
    """Also when keys are dealt again: a ball of near fingerprints and unrelated ones."""
    r = random.Random(radius)
    fps = {r.getrandbits(64) for _ in range(150)}
    for centre in [0, (1 << 64) - 1, *list(fps)[:3]]:
        fps |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(40)}
    fps = sorted(fps)
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    nodes = materialize(spark.createDataFrame([(s,) for s in signed], "fp long"), "test-fps")
    got = sorted(tuple(sorted((signed[x.a], signed[x.b]))) for x in near_pairs(nodes, radius, split_at).collect())
    want = sorted((a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= radius)
    assert got == want


def test_no_python_in_the_plan(spark):
    plan = edited_fingerprints(frame(spark, corpus(3)))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|Pandas", plan)


def test_fingerprints_tell_edits_from_strangers(spark):
    found = edited_fingerprints(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    edited, strange = found.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert edited > 0.62 and strange < 0.55
