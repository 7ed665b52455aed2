"""Suffix-array dedup by a depth-limited radix sort.

Suffixes need ordering only through the threshold (``width`` bytes): suffixes that are equal so far
are exactly the repeated windows. The sort runs most significant digit first, and a suffix leaves as
soon as its group lies in one document:

1. First digit. A window's digit is its leading gram of half the width, picked by content: the gram of
   least hash among all grams of the window, so equal windows pick the same. Shards send the sorted
   digits to owners, Golomb-coded, and learn which occur in two documents.
2. All further digits at once. Suffixes left over are sorted by the 64-bit fingerprint of their
   ``width`` bytes and dealt by its leading digits to owners. Documents were dealt to shards by id, so
   an owner tells a shard by one bit for each digit whether a smaller document has the window.

Whole documents that equal an earlier one are settled by their digest and do not enter the sort.
Windows are equal if their 64-bit fingerprints are; their bytes are not compared. The fingerprint is a
polynomial with a key that each call draws anew, so that no text can be written to collide. For windows
that differ, the chance of a match is not proven to be 2**-64: the polynomial is taken modulo 2**64, where
differences of a regular form lose some bits. The result does not depend on the key but for such matches.
"""

from __future__ import annotations

import hashlib
import secrets

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from frostlake.llm import exchange as X
from frostlake.llm.common import fresh_name, materialize, numbered, small_enough

#: Text bytes of a shard (a longer document is a shard of its own) and of a partition by id.
SHARD_BYTES = 4_000_000
PART_BYTES = 48_000_000
HASHES_PER_OWNER = 2_000_000
#: Fixed value: an odd multiplier for mixing.
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Positions that are hashed at a time: their arrays stay in the processor's cache.
BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    step = np.full(n, np.uint64(base))
    step[0] = 1
    return np.cumprod(step, dtype=np.uint64)


class Grams:
    """Rolling hashes by a key: element i is that of the gram of some width that starts at byte i."""

    def __init__(self, longest: int, key: bytes):
        drawn = [int.from_bytes(hashlib.sha256(key + x).digest()[:8], "big") for x in [b"base", *(bytes([b]) for b in range(256))]]
        base = drawn[0] & ~7 | 5  # odd, and of the greatest order modulo 2**64
        self.table = np.array([x | 1 for x in drawn[1:]], np.uint64)
        self.up = _powers(base, longest + 1)
        self.down = _powers(pow(base, -1, 1 << 64), longest + 1)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.table[raw] * self.up[: len(raw)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, width: int) -> np.ndarray:
        h = sums[width:] - sums[:-width]
        h *= self.down[: len(h)]
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        return h


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """Least value among ``span`` consecutive ones, by doubling."""
    out, have = h, 1
    while have < span:
        step = min(have, span - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Shard:
    """Documents laid end to end; windows cross none of their borders."""

    def __init__(self, text: bytes, sizes: np.ndarray, width: int, key: bytes):
        self.raw, self.sizes, self.width = np.frombuffer(text, np.uint8), sizes, width
        self.starts = np.cumsum(sizes) - sizes
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.grams = Grams(BLOCK + width, key)

    def blocks(self, windows: bool):
        """(first position, digit, whether the window lies in one document, window hashes if asked for) by block."""
        width, gram = self.width, -(-self.width // 2)
        for a in range(0, len(self.raw) - width + 1, BLOCK):
            sums = self.grams.sums(self.raw[a : a + BLOCK + width - 1])
            digit = _least(self.grams.of(sums, gram), width - gram + 1)
            inside = self.doc[a : a + len(digit)] == self.doc[a + width - 1 : a + width - 1 + len(digit)]
            yield a, digit, inside, self.grams.of(sums, width) if windows else None


def _first_digits(shard: Shard, ranks: np.ndarray, bits: int) -> np.ndarray:
    """Sorted digits of the shard, twice if two of its documents have it."""
    digits, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for a, digit, inside, _ in shard.blocks(False):
        doc = shard.doc[a : a + len(digit)]
        new = np.flatnonzero(np.r_[True, (digit[1:] != digit[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]] & inside)
        digits.append(digit[new])
        docs.append(ranks[doc[new]])
    digit, rank = np.concatenate(digits) >> np.uint64(64 - bits), np.concatenate(docs)
    order = np.argsort(digit)
    digit, rank = digit[order], rank[order]
    if not len(digit):
        return digit
    edge = np.flatnonzero(np.r_[True, digit[1:] != digit[:-1]])
    twice = np.maximum.reduceat(rank, edge) > np.minimum.reduceat(rank, edge)
    return np.repeat(digit[edge], 1 + twice)


def _open(replies: list[dict], values: np.ndarray, bits: int, owners: int) -> np.ndarray:
    """Values that the replies (owner, n, bitmap) flag among the shard's own sorted list."""
    maps = {r["owner"]: X.open_bitmap(r["bitmap"], r["n"]) for r in replies}
    got = [values[a:b][maps[o]] for o, a, b in X.cuts(values, bits, owners)]
    return X.distinct(np.concatenate(got)) if got else np.empty(0, np.uint64)


def _has(values: np.ndarray, among: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Which ``values`` are in the sorted ``among``; the bit table first, if there is one, as most are not."""
    if not len(among):
        return np.zeros(len(values), bool)
    maybe = np.ones(len(values), bool) if table is None else table[values & np.uint64(len(table) - 1)]
    some = values[maybe]
    at = np.searchsorted(among, some)
    at[at == len(among)] = 0
    maybe[maybe] = among[at] == some
    return maybe


def _left_over(shard: Shard, digits: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of windows whose first digit is in two documents."""
    table = np.zeros(1 << max(10, (8 * len(digits)).bit_length()), bool)
    table[digits & np.uint64(len(table) - 1)] = True
    at, windows = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for a, digit, inside, window in shard.blocks(True):
        change = np.r_[True, digit[1:] != digit[:-1]]
        ok = _has(digit[change] >> np.uint64(64 - bits), digits, table)
        here = np.flatnonzero(ok[np.cumsum(change) - 1] & inside)
        at.append(here + a)
        windows.append(window[here])
    return np.concatenate(at), np.concatenate(windows)


def _cut_shards(schema: pa.Schema):
    """(shard, text, sizes, ranks, rows, ids): documents in order of id, laid end to end and compressed."""

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        texts, rows, ids, ranks, held, rank, last = [], [], [], [], 0, -1, None

        def flush():
            ints = lambda x: np.array(x, np.int64).tobytes()
            row = ((part << 32) + count, zstandard.compress(b"".join(texts), 1), ints([len(t) for t in texts]), ints(ranks), ints(rows), ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
                text = text.as_py() or b""
                if rank < 0 or doc_id != last:
                    if texts and held + len(text) > SHARD_BYTES:
                        yield flush()
                        texts, rows, ids, ranks, held, rank, count = [], [], [], [], 0, -1, count + 1
                    rank, last = rank + 1, doc_id
                texts.append(text)
                rows.append(row)
                ids.append(doc_id)
                ranks.append(rank)
                held += len(text)
        if texts:
            yield flush()

    return run


def _load(row: dict, width: int, key: bytes) -> tuple[Shard, bytes, np.ndarray]:
    ints = lambda x: np.frombuffer(x, np.int64)
    text = zstandard.decompress(row["text"]) if len(row["text"]) else b""
    return Shard(text, ints(row["sizes"]), width, key), text, ints(row["ranks"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, row_col: str | None = None, key: bytes | None = None) -> DataFrame:
    """One row per row of ``docs``: (row_id, doc_id, n_bytes, spans, kept_text).

    A byte is removed if some ``width``-byte string that covers it also starts in a document with a
    smaller id; strings are judged on the input and never cross documents. spans are the maximal
    removed byte ranges [begin, end); kept_text (binary, as a cut may fall inside a character) is what
    is left. Rows with the same id are one document in this sense: none is the smaller. A null id is
    larger than all others, and null ids are equal. A null text is empty. Texts shorter than
    ``width`` are never cut. An empty table gives no rows; other columns are not read. ``key`` is that of
    the fingerprints; None draws one.
    """
    key = key or secrets.token_bytes(16)  # one value for all tasks and their retries
    spark = docs.sparkSession
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        docs = numbered(docs.select(id_col, text_col), row_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))

    # whole copies of a smaller document
    slim = materialize(docs.select("row", "doc_id", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("sha")), "texts")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    first = slim.where(F.col("n") >= width).groupBy("sha").agg(F.min(order).alias("first"), F.count("*").alias("size")).where("size > 1")
    copies = slim.join(small_enough(materialize(first, "first-texts")), "sha").where(F.col("first") < order).select("row", "doc_id", "n")
    copies = materialize(copies, "copies")
    total = slim.agg(F.sum("n")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // PART_BYTES))

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL("shard long, text binary, sizes binary, ranks binary, rows binary").add("ids", T.ArrayType(id_type))
    left = docs.join(small_enough(copies.select("row")), "row", "left_anti")
    dealt = left.repartitionByRange(parts, F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    shards = materialize(dealt.mapInArrow(_cut_shards(to_arrow_schema(schema)), schema), "shards")

    bits = min(62, max(24, total.bit_length() + 8))
    owners = max(spark.sparkContext.defaultParallelism, -(-total // (8 * HASHES_PER_OWNER)))

    def digits(batches):
        for b in batches:
            for row in b.to_pylist():
                shard, _, ranks = _load(row, width, key)
                out = X.list_frame(row["shard"], _first_digits(shard, ranks, bits), bits, owners)
                yield pa.RecordBatch.from_pandas(out, list_schema, preserve_index=False)

    list_schema = to_arrow_schema(T.StructType.fromDDL(X.LIST_SCHEMA))
    one = materialize(X.answer(shards.mapInArrow(digits, X.LIST_SCHEMA), bits, owners), "digit-replies")

    def suffixes(own: pa.Table, replies: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        shard, _, ranks = _load(row, width, key)
        _, window = _left_over(shard, _open(replies.to_pylist(), _first_digits(shard, ranks, bits), bits, owners), bits)
        return pa.Table.from_pandas(X.list_frame(row["shard"], X.distinct(window), 64, owners), list_schema, preserve_index=False)

    two = shards.groupBy("shard").cogroup(one.groupBy("shard")).applyInArrow(suffixes, X.LIST_SCHEMA)
    two = materialize(X.answer(two, 64, owners, earlier=True), "window-replies")
    out_schema = T.StructType.fromDDL("row long, n_bytes long, edges array<bigint>, kept_text binary").add("doc_id", id_type)
    arrow_out = to_arrow_schema(out_schema)

    def spans(own: pa.Table, replies: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        replies = replies.to_pylist()
        shard, text, ranks = _load(row, width, key)
        digits_hit = _open([r for r in replies if r["pass"] == 1], _first_digits(shard, ranks, bits), bits, owners)
        at, window = _left_over(shard, digits_hit, bits)
        rank = ranks[shard.doc[at]]
        values, which = np.unique(window, return_inverse=True)
        earlier = _has(window, _open([r for r in replies if r["pass"] == 2], values, 64, owners))
        least = np.full(len(values), np.iinfo(np.int64).max)
        np.minimum.at(least, which, rank)
        begin = at[earlier | (rank > least[which])]
        delta = np.zeros(len(text) + 1, np.int32)  # each position begins and ends one window at most
        delta[begin] += 1
        delta[begin + width] -= 1
        cut = np.cumsum(delta[:-1]) > 0
        edges, kept = [], []
        for a, n in zip(shard.starts.tolist(), shard.sizes.tolist()):
            here = cut[a : a + n]
            edges.append(np.flatnonzero(np.diff(here, prepend=False, append=False)).tolist())
            kept.append(np.frombuffer(text, np.uint8, n, a)[~here].tobytes() if edges[-1] else text[a : a + n])
        columns = {"row": np.frombuffer(row["rows"], np.int64), "n_bytes": shard.sizes, "edges": edges, "kept_text": kept, "doc_id": row["ids"]}
        return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in arrow_out], schema=arrow_out)

    replies = one.withColumn("pass", F.lit(1)).union(two.withColumn("pass", F.lit(2)))
    found = shards.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(spans, out_schema)
    span_type = "array<struct<begin:bigint,end:bigint>>"
    pair = lambda i: F.struct(F.col("edges")[i.cast("int")].alias("begin"), F.col("edges")[(i + 1).cast("int")].alias("end"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("edges") - 2, F.lit(2)), pair)
    spans_of = F.when(F.size("edges") == 0, F.array().cast(span_type)).otherwise(pairs.cast(span_type))
    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("n").alias("end"))).cast(span_type)
    return found.select(F.col("row").alias("row_id"), "doc_id", "n_bytes", spans_of.alias("spans"), "kept_text").union(
        copies.select("row", "doc_id", F.col("n").cast("long"), whole, F.lit(b""))
    )
