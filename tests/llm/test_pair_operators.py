"""Exact dedup, SimHash dedup, suffix dedup and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from frostlake.llm import exchange as X
from frostlake.llm import suffix_dedup as SD
from frostlake.llm.common import connected_components
from frostlake.llm.decontaminate import contamination, find_matches, unvarint, varint
from frostlake.llm.exact_dedup import exact_dedup, keep_distinct
from frostlake.llm.simhash_dedup import Ring, _forest, hamming_links, keep_one_of_each, simhash_dedup
from frostlake.llm.suffix_dedup import suffix_dedup

WORDS = "the of and tree river stone cloud light small wind field river walk seven Ünder naïve".split()


def table(spark, rows, extra=True):
    """(doc_id, text) rows with columns whose names clash with the operators' own."""
    rows = [(i, t, "x", 1, 2) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, _row int, fp int")
    return df if extra else df.select("doc_id", "text")


def corpus(seed, n=60):
    r = random.Random(seed)
    base = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(n)]
    out = []
    for i in range(n):
        t = r.choice(base)
        if r.random() < 0.3:
            t = t.replace(" ", "\n", 1) + "  "
        if r.random() < 0.3:
            t = t + " " + r.choice(base)
        out.append((i, t))
    return [*out, (1000, None), (1001, ""), (1002, " \t"), (1003, "word " * 30_000), (1004, "word " * 30_000 + "end")]


# ---------------------------------------------------------------- exchange


@given(st.lists(st.integers(0, 2**40 - 1), max_size=300), st.integers(1, 9))
def test_golomb_lists_round_trip(values, owners):
    values = np.sort(np.array(values, np.uint64))
    frame = X.list_frame(3, values, 40, owners)
    got = [X.open_list(r.owner, r.n, r.low, r.code, 40, owners) for r in frame.itertuples()]
    assert (np.concatenate(got) if got else values).tolist() == values.tolist()


@given(st.lists(st.integers(0, 2**50), max_size=200))
def test_varints_round_trip(values):
    assert unvarint(varint(np.array(values, np.int64))).tolist() == values


def test_connected_components(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 200) - 100, r.randint(0, 200) - 100) for _ in range(120)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- exact dedup


def brute_exact(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i, k))
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0, m[3]))
        out += [(m[2], best[2], len(members), m[3] == best[3], hashlib.sha256(body.encode()).hexdigest()) for m in members]
    return out


@pytest.mark.parametrize("rows", [corpus(1), corpus(2) + [(None, "the of"), (None, "the  of"), (5, "the of"), (5, "the of")], []])
def test_exact_dedup(spark, rows):
    got = exact_dedup(table(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    key = lambda r: tuple(map(str, r))
    got, want = sorted(map(tuple, got), key=key), sorted(brute_exact(rows), key=key)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert sum(g[3] for g in got) == sum(w[3] for w in want) == len({w[4] for w in want})
    assert keep_distinct(table(spark, rows)).count() == len({w[4] for w in want})


def test_exact_dedup_survives_false_alarms(spark, monkeypatch):
    from frostlake.llm import exact_dedup as E

    monkeypatch.setattr(E, "_fingerprint", lambda digest, bits: digest[0] >> 6)  # four fingerprints for all
    rows = corpus(3)
    got = exact_dedup(table(spark, rows)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute_exact(rows))


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(fps, d):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    every = sorted(set(fps))
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            if bin(a ^ b).count("1") <= d:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in every}


def test_simhash_dedup(spark):
    rows = corpus(4) + [(None, "the of"), (50_000, "The OF"), (50_000, "the of")]
    got = simhash_dedup(table(spark, rows)).collect()
    fps = {(i, t): brute_fingerprint(t) for i, t in rows}
    part = components(fps.values(), 2)
    first = {}
    for (i, _), f in fps.items():
        if i is not None:
            first[part[f]] = min(first.get(part[f], i), i)
    want = sorted(((i, f"{f:016x}", first[part[f]]) for (i, t), f in [(x, fps[x]) for x in rows]), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert sum(r["kept"] for r in got) == len(first)
    assert keep_one_of_each(table(spark, rows)).count() == len(first)
    assert simhash_dedup(table(spark, [])).count() == 0


@pytest.mark.parametrize("d", [0, 1, 2, 3])
@pytest.mark.parametrize("split_at", [10, 50_000])
def test_hamming_links_lose_none(spark, d, split_at):
    r = random.Random(d)
    fps = {r.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:6]:  # neighbourhoods, one of them large
        for _ in range(200 if f == min(list(fps)[:6]) else 5):
            for _ in range(r.randint(1, d + 1)):
                f ^= 1 << r.randint(0, 63)
            fps.add(f)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    links = hamming_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), d, split_at)
    got = {x["node"] % 2**64: x["root"] % 2**64 for x in connected_components(links).collect()}
    same = lambda parts: sorted(sorted(f for f in fps if parts.get(f, f) == p) for p in {parts.get(f, f) for f in fps})
    assert same(got) == same(components(fps, d))


def test_forest_by_masks_equals_pairs():
    r = np.random.default_rng(1)
    ring, key = Ring(2), np.uint64(0)
    free = [b for b in range(64) if not ring.keys[0] >> b & 1]
    fps = np.unique(np.array([key | sum(1 << int(free[b]) for b in r.choice(12, 6, replace=False)) for _ in range(1500)], np.uint64))
    assert len(fps) > len(ring.differences(0))
    a, b = _forest(fps, ring, 0, {})
    a2, b2 = _forest(fps, ring, 0, {0: None})
    assert (dict(zip(a.tolist(), b.tolist()))) == dict(zip(a2.tolist(), b2.tolist()))


# ---------------------------------------------------------------- suffixes


def brute_suffix(rows, width):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    big = float("inf")
    for i, t in texts:
        for p in range(len(t) - width + 1):
            w = t[p : p + width]
            first[w] = min(first.get(w, big), big if i is None else i)
    out = []
    for i, t in texts:
        cut = np.zeros(len(t) + 1, int)
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < (big if i is None else i):
                cut[p] += 1
                cut[p + width] = cut[p + width] - 1 if p + width < len(t) else 0
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < (big if i is None else i):
                gone[p : p + width] = True
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).tolist()
        out.append((i, len(t), edges, bytes(b for b, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("width", [50, 9])
def test_suffix_dedup(spark, monkeypatch, small, width):
    if small:
        monkeypatch.setattr(SD, "SHARD_BYTES", 500)
    r = random.Random(7)
    rows = [(i, t) for i, t in corpus(6) if i < 1003] + [(None, WORDS[0] * 40), (None, WORDS[0] * 40), (30, "abc" * 30), (30, "abc" * 30), (2000, "x" * 120), (1999, "x" * 60), (-5, "é" * 30)]
    r.shuffle(rows)
    got = suffix_dedup(table(spark, rows), width=width).collect()
    got = sorted(((x["doc_id"], x["n_bytes"], [[s["begin"], s["end"]] for s in x["spans"]], bytes(x["kept_text"])) for x in got), key=str)
    assert got == sorted(brute_suffix(rows, width), key=str)
    assert suffix_dedup(table(spark, [])).count() == 0


# ---------------------------------------------------------------- decontamination


def brute_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, size=10):
    words, hit, found = brute_words(text), set(), set()
    for item, t in items:
        w = brute_words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            win = w[i : i + size]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(item)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


@pytest.mark.parametrize("blocks", [False, True])
def test_contamination(spark, monkeypatch, blocks):
    from frostlake.llm import decontaminate as D

    if blocks:
        monkeypatch.setattr(D, "BLOCK_CHARS", 60)
        monkeypatch.setattr(D, "SHARD_POSTINGS", 40)
    r = random.Random(9)
    items = [(i, " ".join(r.choice(WORDS) for _ in range(n))) for i, n in enumerate([3, 9, 10, 11, 25, 1, 40])] + [(3, "seven stone"), (None, "wind wind field"), (20, None), (21, "--"), (4, "wind walk")]
    rows = corpus(8, 40) + [(2000 + k, f"pre {t}, post!" * (k + 1)) for k, (_, t) in enumerate(items) if t] + [(None, items[4][1]), (3000, items[4][1]), (3000, items[4][1])]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = contamination(table(spark, rows), bench).collect()
    assert sorted(((x["doc_id"], x["n_words"], x["n_hit"], x["item_ids"]) for x in got), key=str) == sorted(((i, *brute_hits(t, items)) for i, t in rows), key=str)
    none = contamination(table(spark, rows), bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(x["n_hit"] or x["item_ids"] for x in none)
    assert contamination(table(spark, []), bench).count() == 0


def test_proximity_matches(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, "zero " + item), (2, "two one x three four five six y eight seven nine ten z"), (3, "ten nine a b c d e f eight seven six five four three two one"), (4, "one two three"), (5, "x " * 500 + "ten nine eight seven six five four three two one")]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    docs, found = find_matches(table(spark, rows), bench, slop=2)
    ids = {x["row"]: x["doc_id"] for x in docs.collect()}
    got = sorted((ids[x["row"]], x["kind"], x["begin"]) for x in found.collect())
    assert got == [(1, "near", 1), (1, "phrase", 1), (2, "near", 0), (5, "near", 500)]


def test_suffix_fingerprints_are_keyed(spark):
    raw = np.frombuffer(b"the same bytes under two keys are hashed apart, and each key hashes them alike: the same bytes", np.uint8)
    hashes = [g.of(g.sums(raw), 14) for g in (SD.Grams(200, k) for k in (b"a", b"b", b"a"))]
    assert (hashes[0] == hashes[2]).all() and not (hashes[0] == hashes[1]).any()
    assert hashes[0][0] == hashes[0][-1] and len(set(hashes[0].tolist())) == len(hashes[0]) - 1
    rows = [(i, "one " * (i % 7) + "a passage that is in many of the documents, and long enough to go" + str(i % 3)) for i in range(20)]
    cuts = [sorted(map(str, suffix_dedup(table(spark, rows), key=k).drop("row_id").collect())) for k in (b"a", b"b", None)]
    assert cuts[0] == cuts[1] == cuts[2]
