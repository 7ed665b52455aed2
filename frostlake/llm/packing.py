"""Packing into optimal length buckets.

The global histogram of token counts goes to the driver in a bounded number of bins; dynamic
programming over it chooses the bucket boundaries that pad least among the bins' longest lengths. To 1024
tokens that is the least padding of all; beyond, a bin spans up to 1/512 of its lengths, so the padding of all is
above the least by less than 1/512 of the padded lengths. Each document is padded to its
bucket's longest length, and batches of a token budget form inside each bucket. Places in a bucket are
numbered without gaps by counting in hashed parts first, so a bucket that holds most rows is no one
task's work.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.llm.common import fresh_name, materialize, with_row_id

#: The split pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose token count a worker remembers, and rows of a counted part.
REMEMBERED = 400_000
PART_ROWS = 50_000
_TWO_BLANKS = re.compile(r"\s\s")


class TokenCounter:
    """Token counts under a byte-level vocabulary (a file of base64 token and rank on each machine)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        # No token spans a single space and what precedes it, so words can be counted one by one.
        if _TWO_BLANKS.search(text):
            return len(self.encode(text))
        first, *words = text.split(" ")
        known, total = self.known, len(self.encode(first))
        for w in words:
            n = known.get(w)
            if n is None:
                n = len(self.encode(" " + w))
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(w) < 100:
                    known[w] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(row, doc_id, n_tokens) of every row; a null text has no tokens."""
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        docs = with_row_id(docs, row_col)
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        counter = TokenCounter(vocabulary)
        for b in batches:
            counts = pa.array([counter.count(t or "") for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), counts], ["row", "doc_id", "n_tokens"])

    return docs.mapInArrow(run, T.StructType([*docs.select("row", "doc_id").schema, T.StructField("n_tokens", T.LongType())]))


def best_boundaries(longest: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Boundaries of at most ``buckets`` runs of bins that pad least.

    A run from bin i to j pads count * longest[j] - sum. That cost has the quadrangle inequality, so
    the best first bin moves one way with j, and each layer is solved by halving.
    """
    m = len(longest)
    if not m:
        return []
    c, s = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(sums)]
    best = c[1:] * longest - s[1:]
    cuts = [np.zeros(m, np.int64)]
    for _ in range(min(buckets, m) - 1):
        layer, cut = best.copy(), np.zeros(m, np.int64)
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            i = np.arange(lo, min(hi, j) + 1)  # the last run is bins i..j
            cost = np.where(i > 0, best[i - 1], 0) + (c[j + 1] - c[i]) * longest[j] - (s[j + 1] - s[i])
            k = int(np.argmin(cost))
            layer[j], cut[j] = cost[k], i[k]
            todo += [(a, j - 1, lo, int(i[k])), (j + 1, b, int(i[k]), hi)]
        best = layer
        cuts.append(cut)
    ends, j = [], m - 1
    for cut in reversed(cuts):
        ends.append(int(longest[j]))
        j = int(cut[j]) - 1
        if j < 0:
            break
    return ends[::-1]


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(longest, count, sum) by bin: one for each length to 1024, 512 to each doubling beyond, so at
    most some 28,000 for any input."""
    shift = F.greatest(F.lit(0), F.length(F.bin(F.col("n_tokens") - 1)) - 10).cast("int")
    bins = F.when(F.col("n_tokens") > 1024, F.expr("shiftleft(shiftright(n_tokens - 1, s) + 1, s)")).otherwise(F.col("n_tokens"))
    rows = lengths.withColumn("s", shift).groupBy(bins.alias("bin")).agg(F.max("n_tokens").alias("longest"), F.count("*").alias("n"), F.sum("n_tokens").alias("sum"))
    got = np.array(sorted((r["longest"], r["n"], r["sum"]) for r in rows.collect()), np.int64).reshape(-1, 3)
    return got[:, 0], got[:, 1], got[:, 2]


def pack(lengths: DataFrame, buckets: int = 16, budget: int = 65_536, part_rows: int = PART_ROWS) -> DataFrame:
    """``lengths`` (row, doc_id, n_tokens) with (bucket, bucket_tokens, padding, batch, place).

    Documents are padded to bucket_tokens, the longest length of their bucket; a batch takes as many
    as the token budget allows at that length, at least one (so a document beyond the budget is a
    batch of its own, never cut). Only the last batch of a bucket may be partly filled. Batches are
    numbered within their bucket. Documents without tokens (null and empty texts) are packed like
    others; ties go by hash and row number. An empty table gives no rows. ``lengths`` must be a
    written table.
    """
    ends = best_boundaries(*histogram(lengths), buckets)
    parts = max(1, -(-lengths.count() // part_rows))
    edges = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array(F.lit(0).cast("long"))
    placed = lengths.withColumn("bucket", F.size(F.filter(edges, lambda e: e < F.col("n_tokens"))))
    placed = placed.withColumn("bucket_tokens", F.element_at(edges, F.col("bucket") + 1)).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("n_tokens", "row")) - 1 + F.col("offset")
    fits = F.when(F.col("bucket_tokens") > 0, F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens")))).otherwise(F.lit(budget)).cast("long")
    ranked = placed.join(offsets, ["bucket", "part"]).withColumn("rank", rank).withColumn("fits", fits)
    return ranked.select(
        "row", "doc_id", "n_tokens", "bucket", "bucket_tokens",
        (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
        F.floor(F.col("rank") / F.col("fits")).cast("long").alias("batch"),
        (F.col("rank") % F.col("fits")).alias("place"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """``pack`` of the token counts of ``docs``; columns other than id and text are not read."""
    lengths = materialize(token_counts(docs, vocabulary, id_col, text_col), "token-counts")
    return pack(lengths, buckets, budget)
