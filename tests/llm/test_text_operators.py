"""Chat collapse, license scan, line dedup and the quality classifier."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from frostlake.llm import chat, licenses, quality
from frostlake.llm.chat import format_chats
from frostlake.llm.licenses import TEMPLATES, Scanner, license_scan
from frostlake.llm import line_dedup as lines_of
from frostlake.llm.line_dedup import line_dedup
from frostlake.llm.quality import classify, features, fit, keep_quality, passages, score

# ---------------------------------------------------------------- chats


def brute_chats(rows):
    convs = {}
    for c, t, role, text in set(rows):
        convs.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    said = {c: tuple((r if k else None, x if y else None) for _, _, k, r, y, x in sorted(v)) for c, v in convs.items()}
    groups = {}
    for c, s in said.items():
        groups.setdefault(s, []).append(c)
    out = []
    for s, ids in groups.items():
        if any(len(o) > len(s) and o[: len(s)] == s for o in groups):
            continue
        first = min(ids, key=lambda i: (i is None, i or 0))
        out += [(first, k, len(s), len(ids), f"<|im_start|>{r if r is not None else 'user'}\n{(x or '').replace('<|im_end|>', '< |im_end|>')}<|im_end|>\n") for k, (r, x) in enumerate(s)]
    return out


@pytest.mark.parametrize("block", [2, 1000])
def test_format_chats(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    r = random.Random(3)
    rows = []
    for c in range(60):
        base = random.Random(r.randint(0, 6))
        rows += [(c, t, base.choice(["user", "assistant"]), f"say {base.randint(0, 2)} <|im_end|>") for t in range(r.randint(1, 7))]
    rows += rows[:9] + [(None, 0, "user", "x"), (100, None, None, None), (100, 0, "user", ""), (101, 0, "user", "a"), (101, 0, "user", "b"), (102, 0, "user", "a"), (103, 0, None, None), (104, 0, "user", "")]
    rows += [(200, t, "user", f"long {t}") for t in range(40)] + [(201, t, "user", f"long {t}") for t in range(39)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, place int")
    got = format_chats(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_chats(rows), key=str)
    assert format_chats(df.limit(0)).count() == 0


# ---------------------------------------------------------------- licenses


def test_every_template_is_found_as_itself():
    scanner = Scanner(TEMPLATES, max_changes=1)
    for name, text in TEMPLATES.items():
        noise = f"Words before. {text}\nWords after"
        assert [(f[0], noise.encode()[f[1] : f[2]].decode()) for f in scanner.scan(noise.encode())] == [(name, text)]


def test_license_scan_against_plain_search(spark):
    r = random.Random(4)
    notices = list(TEMPLATES.items())
    rows = [(1, None), (2, ""), (3, "A license to think is no notice."), (4, "w " * 300_000 + notices[0][1]), (5, "Licensed under the Apache License, Version 1.1."), (None, notices[1][1])]
    for i in range(10, 60):
        parts = [r.choice([*(t for _, t in notices), "Some words here.", "More of them!"]) for _ in range(r.randint(1, 5))]
        rows.append((i, r.choice(["\n", " "]).join(parts)))
    rows += [(10, rows[6][1])]
    docs = spark.createDataFrame([(*x, "m", 0) for x in rows], "doc_id long, text string, license string, row_id int")
    got = license_scan(docs).collect()
    exact = sorted(((x["doc_id"], x["license"], x["begin"]) for x in got if not x["removed"] and not x["added"]), key=str)
    want = sorted(((i, name, len(t[: m.start()].encode())) for i, t in rows if t for name, n in notices for m in re.finditer(re.escape(n), t)), key=str)
    assert exact == want
    near = [(x["doc_id"], x["license"], x["removed"], x["added"]) for x in got if x["removed"] or x["added"]]
    assert near == []  # "1.1" for "2.0" is four words apart
    assert [x["license"] for x in license_scan(docs.where("doc_id = 5"), max_changes=4).collect()] == ["Apache-2.0"]
    assert license_scan(docs.limit(0)).count() == 0


def test_wrapped_changed_and_longer_notices(spark):
    apache = licenses.FORMS["Apache-2.0"][0]
    mit = licenses.FORMS["MIT"][0]
    wrap = lambda t: "/*\n * " + re.sub(r"((?:\S+ ){6})", r"\1\n * ", t) + "\n */"
    rows = [
        ("Licensed under the Apache License,\nVersion 2.0.", ["Apache-2.0"]),
        ("éé “Released under the MIT\n# Licence.”", ["MIT"]),
        ("We say that this program is licensed under the GNU General Public License, version 3, and more", ["GPL-3.0"]),
        ("It is released today under the MIT License. Use it", ["MIT"]),
        (wrap(apache), ["Apache-2.0"]),
        ("Copyright 2020 Someone\n\n" + wrap(mit.replace("AUTHORS OR ", "")), ["MIT"]),
        ("# SPDX-License-Identifier: (EPL-2.0 OR ISC)\ncode", ["(EPL-2.0 OR ISC)"]),
        ("Released under the BSD License.", []),
        ("This work is licensed under the GNU General Public License, version 4.", []),
        ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = sorted(license_scan(docs).collect(), key=lambda x: (x["doc_id"], x["begin"]))
    assert [[x["license"] for x in got if x["doc_id"] == i] for i in range(len(rows))] == [w for _, w in rows]
    for i, begin, end in ((0, 0, 47), (1, 8, 41)):
        assert [(x["begin"], x["end"]) for x in got if x["doc_id"] == i] == [(begin, end)]


# ---------------------------------------------------------------- lines


def brute_lines(rows, max_bits=3, similarity=0.8):
    norm = lambda s: re.sub("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", s.lower()).strip()
    first, occurrences = {}, []
    for k, (i, t) in enumerate(rows):
        for at, line in enumerate(t.split("\n") if t is not None else []):
            if n := norm(line):
                occurrences.append(((i is None, i or 0, k, at), n))
    for place, n in sorted(occurrences):
        first.setdefault(n, place)

    def print_of(n):
        hs = [xxhash.xxh64_intdigest(w.encode(), 42) for w in n.split(" ")]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for x, ca in enumerate(a, 1):
            last, row[0] = row[0], x
            for y, cb in enumerate(b, 1):
                last, row[y] = row[y], min(row[y] + 1, row[y - 1] + 1, last + (ca != cb))
        return row[-1]

    root = {n: n for n in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    forms = list(first)
    prints = {n: print_of(n) for n in forms}
    for x, a in enumerate(forms):
        for b in forms[x + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= max_bits and distance(a, b) <= (1 - similarity) * max(len(a), len(b)) + 1e-9:
                p, q = find(a), find(b)
                if p != q:
                    root[max(p, q, key=first.get)] = min(p, q, key=first.get)
    gone = {place[2:] for place, n in occurrences if place != first[find(n)]}
    out = []
    for k, (i, t) in enumerate(rows):
        lines = t.split("\n") if t is not None else []
        kept = [x for at, x in enumerate(lines) if (k, at) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    return out


def test_line_dedup(spark):
    r = random.Random(11)
    vocabulary = [f"w{k}ord" for k in range(60)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 40))) for _ in range(25)]

    def line():
        words = r.choice(base).split()
        for _ in range(r.randint(0, 2)):
            k = r.randrange(len(words) + 1)
            words[k : k + r.randint(0, 1)] = r.choice([[], [r.choice(vocabulary)]])
        return r.choice([" ".join(words), " ".join(words).upper() + "!", "", "--"])

    rows = [(i, "\n".join(line() for _ in range(r.randint(1, 6)))) for i in range(70)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, ""), (92, "\n\n"), (93, "long " * 20_000), (94, "long " * 20_000)]
    got = line_dedup(spark.createDataFrame([(*x, "n", 0) for x in rows], "doc_id long, text string, norm string, at int").coalesce(1))
    got = sorted(((x["doc_id"], x["n_lines"], x["n_dropped"], x["kept_text"]) for x in got.collect()), key=str)
    assert got == sorted(brute_lines(rows), key=str)
    assert any(g[2] for g in got)
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_by_edit_similarity_alone(spark):
    r = random.Random(12)
    vocabulary = [f"{r.choice('bcdfgh')}{k}{r.choice(['a', 'ough', 'ing'])}" for k in range(4000)]
    base = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (1, 2, 2, 3, 4, 5, 6, 8, 10, 14, 20, 30, 50) for _ in range(3)]

    def line():
        words = r.choice(base).split()
        for _ in range(r.randint(0, 1 + len(words) // 10)):
            k = r.randrange(len(words))
            words[k] = r.choice([r.choice(vocabulary), words[k][1:] or "x", words[k] + "s"])
        text = " ".join(words)
        k = r.randrange(len(text))
        return r.choice([text, text[:k] + r.choice("xyz ") + text[k + r.randint(0, 1) :]])

    rows = [(i, "\n".join(line() for _ in range(3))) for i in range(25)]
    rows += [(97, "same " * 30), (98, "same " * 29 + "other"), (99, "Chapter 12"), (100, "Chapter 13"), (101, "ab"), (102, "ac")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    by_rule = lambda bits: sorted(((x["doc_id"], x["n_lines"], x["n_dropped"], x["kept_text"]) for x in line_dedup(docs, max_bits=bits).collect()), key=str)
    wanted = sorted(brute_lines(rows, max_bits=64), key=str)
    assert by_rule(None) == wanted
    assert by_rule(3) != wanted


def test_line_runs_meet_across_bands_at_places_counted_by_block(spark):
    r = random.Random(13)
    lines = [" ".join(f"{r.choice('abcdefgh')}{'o' * r.randint(0, 3)}{r.choice('é-'[:1] + 'xyz')}" for _ in range(r.randint(1, 60))) for _ in range(150)]
    lines += ["one two three " * 12 + "end", "x " * 600 + "end"]
    lines = [x.strip() for x in lines]

    def keys(text):
        words = text.split(" ")
        ends = [len(" ".join(words[: i + 1])) for i in range(len(words))]
        found = [(tuple(words[i : i + n]), ends[i]) for n in ((3, 2) if len(words) <= 20 else (3,)) for i in range(len(words) - n + 1)]
        placed = len(words) <= 512 and len({k for k, _ in found}) == len(found)
        out = {}
        for k, at in found:
            out[k] = at if placed else None
        return out

    runs, wanted = [keys(x) for x in lines], set()
    for i, a in enumerate(lines):
        for j, b in enumerate(lines):
            allowed = int(0.2 * len(b) + 1e-6)
            if (len(a), i) < (len(b), j) and len(b) - len(a) <= allowed:
                for k in runs[i].keys() & runs[j].keys():
                    p, q = runs[i][k], runs[j][k]
                    if p is None or q is None or abs(p - q) + abs(len(b) - len(a) + p - q) <= allowed:
                        wanted.add((i, j))
    nodes = spark.createDataFrame([(i, len(x), x) for i, x in enumerate(lines)], "line long, size int, norm string")
    got = {(x["a"], x["b"]) for x in lines_of._run_pairs(lines_of._placed(nodes), 0.8).collect()}
    assert got == wanted and wanted


def test_line_parts_missing_at_their_place_rule_out_far_pairs_only(spark):
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdeé ") for _ in range(n))
    pairs = [("abcd" * 30, "dcba" * 30), ("", "abc"), ("abcdefgh" * 12, "abcdefgh" * 12)]
    for _ in range(150):
        a, edits = text(r.randint(1, 150)), r.randint(0, 40)
        b = list(a)
        for _ in range(edits):
            at = r.randint(0, len(b))
            b[at : at + r.randint(0, 1)] = r.choice(["", text(1)])
        pairs += [(a, "".join(b)), (a, text(len(a)))]
    pairs = [(i, *sorted(p, key=len)) for i, p in enumerate(pairs)]
    found = spark.createDataFrame(pairs, "i int, norm_a string, norm_b string").selectExpr("*", "length(norm_a) size_a", "length(norm_b) size_b", "levenshtein(norm_a, norm_b) d")
    found = found.withColumn("allowed", F.floor(0.2 * F.col("size_b")).cast("int"))
    found = found.withColumn("missing", lines_of._missing(F.col("allowed"))).withColumn("tight", lines_of._missing(F.col("d"))).collect()
    assert all(x["tight"] <= x["d"] for x in found)
    assert all(x["missing"] <= x["d"] for x in found if x["d"] <= x["allowed"])
    assert sum(x["d"] <= x["allowed"] for x in found) > 50
    out = [x["missing"] > x["allowed"] for x in found if x["d"] > x["allowed"] and x["size_b"] >= 60]
    assert len(out) > 50 and sum(out) > 0.5 * len(out)


def test_line_parts_rule_out_long_far_pairs_of_few_syllables_and_no_near_pair_of_any_alphabet(spark):
    r = random.Random(15)
    syllables = "th er on an re he in ed nd ha at en".split() + [" "] * 5
    alphabets = [syllables, list("abcdeghinorst \u00e9\u00e8\u00ff"), list("\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b\u4e5d\U0001f600\U0001f601a ")]
    pairs = []
    for letters in alphabets:
        text = lambda n: "".join(r.choice(letters) for _ in range(n))[:n]
        for _ in range(40):
            a = text(r.randint(500, 700))
            b = list(a)
            for _ in range(r.randint(0, len(a) // 4)):
                at = r.randint(0, len(b))
                b[at : at + r.randint(0, 1)] = r.choice(["", text(1)])
            pairs += [(a, "".join(b)), (a, text(len(a)))]
    pairs = [(i, *sorted(p, key=len)) for i, p in enumerate(pairs)]
    found = spark.createDataFrame(pairs, "i int, norm_a string, norm_b string").selectExpr("*", "length(norm_a) size_a", "length(norm_b) size_b", "levenshtein(norm_a, norm_b) d")
    found = found.withColumn("allowed", F.floor(0.2 * F.col("size_b")).cast("int"))
    found = found.withColumn("missing", lines_of._missing(F.col("allowed"))).withColumn("tight", lines_of._missing(F.col("d"))).collect()
    assert all(x["tight"] <= x["d"] for x in found)
    assert all(x["missing"] <= x["d"] for x in found if x["d"] <= x["allowed"])
    assert sum(x["d"] <= x["allowed"] for x in found) > 60
    out = [x["missing"] > x["allowed"] for x in found if x["i"] < 80 and x["i"] % 2]
    assert len(out) == 40 and sum(out) >= 32


def test_line_pairs_are_compared_in_parts(spark, monkeypatch):
    """Lines that share a lead-in are all candidates of each other; their texts do not travel all at once."""
    r = random.Random(14)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(7))
    rows = [(i, "this is our usual lead in " + " ".join(word() for _ in range(6))) for i in range(60)]
    rows.append((60, rows[7][1] + "s"))
    sizes, similar = [], lines_of._similar
    monkeypatch.setattr(lines_of, "_similar", lambda pairs, similarity: (sizes.append(pairs.count()), similar(pairs, similarity))[1])
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), max_bits=None)
    assert [x["doc_id"] for x in got.collect() if x["n_dropped"]] == [60]
    assert sum(sizes) == 61 * 60 // 2 and max(sizes) < 3 * 61


# ---------------------------------------------------------------- quality


@pytest.mark.parametrize("text", [b"", b"a" * 5000, b"one two " * 700, b"x" * 1499 + b" y"])
def test_passages_cover_the_text(text):
    assert b"".join(passages(text)) == text


def test_attention_finds_the_telling_passage():
    """Only the document is labelled: a bag is bad if one of its passages is."""
    r = np.random.default_rng(0)
    good, bad = features(b"Some plain words in a row here. "), features(b"BUY!! NOW!! BUY!! NOW!!")
    bags, labels = [], r.integers(0, 2, 300)
    for y in labels:
        bag = np.stack([good] * int(r.integers(1, 9))) + r.normal(0, 0.01, (1, quality.DIM))
        if not y:
            bag[r.integers(len(bag))] = bad
        bags.append(bag.astype(np.float32))
    model = fit(bags[:200], labels[:200])
    right = 0
    for bag, y in zip(bags[200:], labels[200:]):
        h, a = model.encode(bag)
        e = np.exp(a - a.max())
        z = (e / e.sum()) @ h @ model.w["c"] + model.w["bc"]
        right += (z[0] > 0) == y
    assert right >= 95


def test_attention_in_steps_equals_attention_at_once(monkeypatch):
    r = np.random.default_rng(0)
    bags = [r.normal(0, 1, (int(n), quality.DIM)).astype(np.float32) for n in r.integers(1, 5, 40)]
    model = fit(bags, r.integers(0, 2, 40), epochs=3)
    text = b"some words, MORE words! and 12 lines\n" * 900
    whole = model.score(text)
    monkeypatch.setattr(quality, "STEP", 3)
    assert abs(model.score(text) - whole) < 1e-5


def test_classifier_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= x["score"] <= 1 for x in got)
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) and x["predicted"] == (x["score"] >= 0.3) for x in got)
    truth = {x["doc_id"]: x["quality"] for x in labels.collect()}
    held = [(x["predicted"], truth[x["doc_id"]]) for x in got if x["held_out"] and x["doc_id"] in truth]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    kept = keep_quality(docs.withColumn("score", docs["doc_id"]), labels)
    assert kept.columns == [*docs.columns, "score"] and {x["doc_id"] for x in kept.select("doc_id").collect()} == {x["doc_id"] for x in got if x["predicted"]}


def test_training_skips_a_document_that_does_not_fit(spark):
    rows = [(i, "word " * 3, i % 2) for i in range(1, 41)]
    first = spark.createDataFrame(rows, "doc_id long, text string, quality int").where(quality.fold(F.col("doc_id")) != 0).orderBy(F.xxhash64("doc_id")).first()["doc_id"]
    rows[first - 1] = (first, "word " * 60_000, first % 2)  # some 200 passages
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert quality.train(docs.drop("quality"), docs.select("doc_id", "quality"), max_passages=50) is not None
    with pytest.raises(ValueError, match="none among the training sample"):
        quality.train(docs.drop("quality"), docs.select("doc_id", "quality"), max_passages=0)


def test_training_takes_part_of_a_class_that_does_not_fit(spark):
    """Of a class whose documents are all too long, or too rare to be in the sample, one document stands for it."""
    rows = [(i, "good " * 12_000 if i % 2 else "bad " * 3, i % 2) for i in range(1, 21)]  # some 40 passages, or one
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    for bounds in ({"max_passages": 20}, {"max_bags": 1}):
        model = quality.train(docs.drop("quality"), docs.select("doc_id", "quality"), **bounds)
        assert model is not None and model.score(b"good " * 300) > model.score(b"bad " * 3)


def test_classifier_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "text", 0), (2, "w " * 100_000, 1)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert [x["score"] for x in score(docs, quality.train(docs, labels)).collect()] == [1.0] * 4  # one class: nothing to learn
    assert classify(docs.limit(0), labels.limit(0)).count() == 0
    r = np.random.default_rng(0)
    model = fit([r.normal(0, 1, (2, quality.DIM)).astype(np.float32) for _ in range(8)], np.arange(8) % 2, epochs=1)
    assert all(0 <= x["score"] <= 1 for x in score(docs, model).collect())
