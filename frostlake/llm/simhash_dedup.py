"""SimHash near-dedup with pigeonring filtering.

A fingerprint is cut into m = 2d + 1 segments, laid in a ring. If two fingerprints differ in at most
d bits, some segment starts a chain in which the first l segments differ in at most l * d / m bits,
for every l. Two segments must therefore be equal: they are the join key of that start. The further
segments must keep the cumulative budgets, and only then all bits are compared.

Equal fingerprints are one node. A key's fingerprints are linked by a forest, not by all pairs, found
with vector operations in time linear in the key's size; a very full key is dealt again by a third
segment, so no task has to hold it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.llm.common import connected_components, drop_rows, fresh_name, materialize, numbered, small_enough, with_row_id

#: A-Z to a-z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A key with more fingerprints is dealt again.
SPLIT_AT = 50_000
#: Keys of at most so many fingerprints are compared by shifted vectors, many keys at once.
SMALL = 32
CHUNK = 200_000


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        a, b = starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist()
        h = np.array([digest(joined[i:j], seed) for i, j in zip(a, b)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(row, doc_id, fp) of (row, doc_id, text)."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t or b"", shingle, seed) for t in b.column("text").cast(pa.large_binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(fps.view(np.int64))], ["row", "doc_id", "fp"])

    return docs.mapInArrow(run, T.StructType([*docs.select("row", "doc_id").schema, T.StructField("fp", T.LongType())]))


class Ring:
    """Segments of a 64-bit fingerprint and the budgets of the chains along them."""

    def __init__(self, max_bits: int):
        self.d, self.m = max_bits, 2 * max_bits + 1
        cuts = [64 * i // self.m for i in range(self.m + 1)]
        self.segments = np.array([((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])], np.uint64)
        self.keys = [int(self.segments[r] | self.segments[(r + 1) % self.m]) for r in range(self.m)]

    def linked(self, diff: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """Whether differences keep every budget of the chain from segment ``start``; the last one is the Hamming check."""
        spent = np.zeros(len(diff), np.int64)
        ok = np.ones(len(diff), bool)
        for k in range(self.m):
            spent += np.bitwise_count(diff & self.segments[(start + k) % self.m])
            ok &= spent * self.m <= (k + 1) * self.d
        return ok

    def differences(self, start: int) -> np.ndarray:
        """All differences but none that keep the budgets of the chain from ``start``."""
        free = [b for b in range(64) if not self.keys[start] >> b & 1]
        some = np.array([sum(1 << b for b in bits) for k in range(1, self.d + 1) for bits in combinations(free, k)], np.uint64)
        return some[self.linked(some, start)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of the pairs (i, j) in the forest ``root``, in which every node points at its root."""
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((nxt := root[root]) != root).any():
            root = nxt
    return root


def _forest(fps: np.ndarray, ring: Ring, start: int, masks: dict) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components among the fingerprints of one key."""
    fps, start = np.sort(fps), start % ring.m
    n = len(fps)
    root = np.arange(n)
    if start not in masks:
        masks[start] = ring.differences(start) if ring.d <= 3 else None
    if masks[start] is None or n <= len(masks[start]):
        for k in range(n - 1):
            j = k + 1 + np.flatnonzero(ring.linked(fps[k + 1 :] ^ fps[k], start))
            root = _join(root, np.full(len(j), k), j)
    else:
        for x in masks[start]:
            other = fps ^ x
            at = np.searchsorted(fps, other)
            at[at == n] = 0
            i = np.flatnonzero((fps[at] == other) & (other > fps))
            root = _join(root, i, at[i])
    own = np.flatnonzero(root != np.arange(n))
    return fps[own], fps[root[own]]


def _near(ring: Ring, split_at: int | None):
    """Links (kind 0: a, b) inside each key of sorted rows (start, key, fp); rows of over-full keys come back (kind 1)."""

    def rows(kind, start, key, a, b):
        one = lambda v, t: pa.array(v, t) if isinstance(v, np.ndarray) else pa.nulls(len(a), t)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), one(start, pa.int32()), one(key, pa.int64()), pa.array(a.view(np.int64)), one(b.view(np.int64) if b is not None else None, pa.int64())], ["kind", "start", "key", "a", "b"])

    def links(start, key, fps, masks):
        edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (start[1:] != start[:-1])])
        size = np.diff(np.r_[edge, len(fps)])
        for e, s in zip(edge[size > SMALL], size[size > SMALL]):
            yield _forest(fps[e : e + s], ring, int(start[e]), masks)
        few = np.repeat((size > 1) & (size <= SMALL), size)
        run = np.repeat(np.arange(len(size)), size)[few]
        fps, start = fps[few], start[few]
        for lag in range(1, SMALL):
            i = np.flatnonzero(run[lag:] == run[:-lag])
            if not len(i):
                break
            ok = i[ring.linked(fps[i] ^ fps[i + lag], start[i])]
            yield fps[ok], fps[ok + lag]

    def run(batches):
        masks: dict = {}
        none = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64))
        held, full = none, None
        for batch in batches:
            got = (batch.column("start").to_numpy(), batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64))
            held = tuple(np.concatenate(x) for x in zip(held, got)) if len(held[0]) else got
            start, key, fps = held
            if not len(fps):
                continue
            if full is not None:
                same = (start == full[0]) & (key == full[1])
                stop = len(same) if same.all() else int(np.argmin(same))
                if stop:
                    yield rows(1, start[:stop], key[:stop], fps[:stop], None)
                full = full if stop == len(fps) else None
                start, key, fps = start[stop:], key[stop:], fps[stop:]
                if not len(fps):
                    held = none
                    continue
            last = (start == start[-1]) & (key == key[-1])
            cut = int(np.argmax(last))
            for a, b in links(start[:cut], key[:cut], fps[:cut], masks):
                yield rows(0, None, None, a, b)
            held = (start[cut:], key[cut:], fps[cut:])
            if split_at is not None and len(held[0]) > split_at:
                full = (held[0][0], held[1][0])
                yield rows(1, *held, None)
                held = none
        if len(held[0]):
            for a, b in links(*held, masks):
                yield rows(0, None, None, a, b)

    return run


def _dealt(keyed: DataFrame) -> DataFrame:
    return keyed.repartition("start", "key").sortWithinPartitions("start", "key", "fp")


def hamming_links(fps: DataFrame, max_bits: int, split_at: int = SPLIT_AT) -> DataFrame:
    """(a, b): links that connect all distinct ``fp`` (long) within ``max_bits`` differing bits of each other."""
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    ring = Ring(max_bits)
    out = "kind tinyint, start int, key long, a long, b long"
    starts = [F.struct(F.lit(r).alias("start"), F.col("fp").bitwiseAND(F.lit(_signed(k))).alias("key")) for r, k in enumerate(ring.keys)]
    keyed = fps.select("fp", F.explode(F.array(*starts)).alias("k")).select("k.start", "k.key", "fp")
    first = materialize(_dealt(keyed).mapInArrow(_near(ring, split_at if max_bits > 1 else None), out), "near")
    links = first.where("kind = 0").select("a", "b")
    again = first.where("kind = 1").select("start", "key", F.col("a").alias("fp"))
    if again.isEmpty():
        return links
    # the key's two segments are equal, so d bits differ in the other 2d - 1 segments: one of them is equal too
    third = []
    for r in range(ring.m):
        for k in range(2, ring.m):
            both = ring.keys[r] | int(ring.segments[(r + k) % ring.m])
            third.append(F.struct(F.lit(r).alias("start"), F.lit(k).alias("third"), F.col("fp").bitwiseAND(F.lit(_signed(both))).alias("key")))
    wide = again.select(F.col("start").alias("own"), "fp", F.explode(F.array(*third)).alias("k")).where("own = k.start")
    wide = wide.select((F.col("k.start") + F.lit(ring.m) * F.col("k.third")).alias("start"), "k.key", "fp")
    # the chain's first segment is start modulo m
    return links.union(materialize(_dealt(wide).mapInArrow(_near(ring, None), out), "near2").select("a", "b"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, seed: int = 42, row_col: str | None = None, split_at: int = SPLIT_AT) -> DataFrame:
    """One row per row of ``docs``: (row_id, doc_id, fp long, fingerprint, component_id, kept).

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles count as often as they
    occur; a text of fewer words is one shingle, one of none (null, empty or blank) has fingerprint 0. A
    bit is set if over half of the shingles' XXH64 have it. Fingerprints at most ``max_bits`` apart are
    linked, and a component's id is the smallest doc_id reachable (null only if all are null). ``kept``
    marks one row of each component: the smallest doc_id (null last), then the first row. An empty table
    gives no rows; other columns are not read.
    """
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        docs = with_row_id(docs, row_col)
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(fingerprints(docs, shingle, seed), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    nodes = materialize(rows.groupBy("fp").agg(best.alias("best"), F.count("*").alias("n")), "nodes")
    parts = connected_components(hamming_links(nodes.select("fp"), max_bits, split_at))
    linked = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "best", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    tops = materialize(linked.where("linked").groupBy("root").agg(F.min("best").alias("top")), "tops")
    groups = linked.where("linked OR n > 1").join(tops, "root", "left").select("fp", F.coalesce("top", "best").alias("top"))
    groups = materialize(groups.select("fp", F.col("top.doc_id").alias("component_id"), F.col("top.row").alias("top_row")), "groups")
    alone = F.col("top_row").isNull()
    return rows.join(small_enough(groups), "fp", "left").select(
        F.col("row").alias("row_id"),
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("top_row") == F.col("row"))).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all their columns, that ``simhash_dedup`` keeps."""
    row = fresh_name(docs, "_row")
    docs = numbered(docs, row)
    found = simhash_dedup(docs, id_col, text_col, shingle, max_bits, row_col=row)
    return drop_rows(docs, row, materialize(found.where(~F.col("kept")).select(F.col("row_id").alias(row)), "near-copies"))
