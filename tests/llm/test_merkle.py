"""The Merkle manifest against a plain construction of the same trees."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from frostlake.llm.merkle import build, descend, fold, manifest, proof
from frostlake.llm.ordering import followers, ordered, ranked
from frostlake.llm.common import materialize

FIELDS = ["doc_id", "source", "n", "text"]
SCHEMA = "doc_id long, lang string, source string, n int, text string, grp string, rank string, path string, digest int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[2], row[3], row[4])))


def climb(nodes):
    """Root of a list of digests, and for each its path from the leaf: [(before, after)]."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for j in range(len(run)):
                for i in owners[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            up_owners.append([i for o in owners[at : at + 8] for i in o])
        nodes, owners = up, up_owners
    return nodes[0], paths


def expected(rows, forge):
    none_first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[1] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[1] == lang), key=lambda r: (none_first(r[0]), leaf(r)))
        trees[lang] = (own, *climb([leaf(r) for r in own]))
    root, upper = climb([trees[g][1] for g in langs])
    out = []
    for lang, above in zip(langs, upper):
        own, sub, paths = trees[lang]
        for r, path in zip(own, paths):
            path = path + above
            h = leaf(forge(r))
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], lang, leaf(r), sub, root, sha("".join(a + b for a, b in path)), h, h == root))
    return out


def corpus(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(["en"] * 6 + ["de", "ü", "Zz"])
        rows.append((i * 3 % 71, lang, r.choice(["a", None, "1:x"]), r.choice([1, None]), r.choice(["Ab", "ab", "", None, "é" * 3, "x" * 5000]), "g", "r", "p", 1))
    rows += [(None, "en", "s", 1, "T", "g", "r", "p", 1), (5, None, None, None, None, "g", "r", "p", 1), (7, "lone", "s", 2, "Only", "g", "r", "p", 1)]
    return rows + rows[:20]  # repeated whole


@pytest.mark.parametrize("n", [0, 9, 150])
def test_manifest_equals_plain_trees(spark, n):
    rows = corpus(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = manifest(df, FIELDS, claims={"text": F.lower("text")})
    got = got.select("id", "group", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256), "folded_root", "verified")
    want = expected(rows, lambda r: (*r[:4], r[4] and r[4].lower()))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_one_row_is_its_own_root(spark):
    df = spark.createDataFrame([(1, "en", "s", 1, "t", "g", "r", "p", 1)], SCHEMA)
    (r,) = manifest(df, FIELDS).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.path == [] and r.verified


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SCHEMA), FIELDS).collect() == []


def test_some_leaves_are_asked_for(spark, tmp_dir):
    """A stored forest answers for a few ranks; a rank beyond the tree gives no row."""
    sizes = {10: 700, 20: 65, 30: 1}
    rows = [(g, n, i, sha(f"{g}:{i}")) for g, n in sizes.items() for i in range(n)]
    nodes = materialize(spark.createDataFrame(rows, "grp long, n long, rank long, digest string"), "test-nodes")
    forest = build(nodes, f"{tmp_dir}/dag")
    assert len(forest.levels) == 4 and spark.read.parquet(f"{tmp_dir}/dag/height=1").columns == ["grp", "n", "left", "rank", "children", "digest"]
    asked = spark.createDataFrame([(10, 0, "a"), (10, 699, "b"), (20, 64, "c"), (30, 0, "d"), (20, 65, "no"), (30, 1, "no"), (99, 0, "no")], "grp long, rank long, who string")
    starts = forest.tops.select("grp", F.expr("cast(array() as array<struct<before:string,after:string>>)").alias("path"))
    tops = {r.grp: (r.digest, r.height) for r in forest.tops.collect()}
    found = descend(forest, starts, asked)
    got = {r.who: r for r in found.join(nodes.drop("n"), ["grp", "rank"]).select("who", "grp", F.size("path").alias("steps"), fold(F.col("path"), F.col("digest")).alias("root")).collect()}
    assert set(got) == set("abcd")
    assert all((r.root, r.steps) == tops[r.grp] for r in got.values())


def test_ordered_places_and_followers(spark):
    """Equal keys and nulls: one order, each place followed by the next one across ranges."""
    r = random.Random(1)
    rows = [(r.choice([None, 1, 2, 2, 2, 3]), i) for i in range(2000)]
    placed = ordered(spark.createDataFrame(rows, "k int, place_ int").repartition(4), [F.col("k").asc_nulls_first()], "place", "test-places")
    got = placed.orderBy("place").collect()
    keys = [x.k for x in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len({x.place for x in got}) == 2000
    after = {x.last: x.following for x in followers(placed, "place").collect()}
    places = [x.place for x in got]
    assert all((after[a] if a in after else a + 1) == b for a, b in zip(places, places[1:])) and after[places[-1]] is None
    of_key = {}
    for x in ranked(placed, "place", "k").orderBy("place").collect():
        assert x.rank == of_key.setdefault(x.k, 0) and x.n == keys.count(x.k)
        of_key[x.k] += 1
