"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every partition digests its rows and sends its sorted fingerprints, compressed, to their owners.
2. Owners answer with duplicate bitmaps; a set bit names a suspect fingerprint.
3. Only suspects are shuffled, with their bytes: equal bytes form a class, a false alarm none.

Copies inside a partition are listed twice at most and equal bytes meet in a map-side combine, so a
text that a third of all rows share costs one list entry and one shuffled copy per partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from frostlake.llm import exchange as X
from frostlake.llm.common import drop_rows, fresh_name, materialize, numbered, small_enough, with_row_id

#: Deleted before texts are compared: ASCII white space.
BLANKS = b" \t\n\x0b\x0c\r"
HASHES_PER_OWNER = 2_000_000


def normalised(texts: pa.Array) -> Iterator[bytes]:
    for t in texts.cast(pa.large_binary()).to_pylist():
        yield (t or b"").translate(None, BLANKS)


def _fingerprint(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "big") >> (64 - bits)


def _send(bits: int, owners: int, schema: pa.Schema):
    """Rows of kind 0 (a digest for each document) and, at the end, of kind 1 (a list for each owner)."""

    def run(batches):
        met: list[np.ndarray] = []
        for batch in batches:
            shas = [hashlib.sha256(t).digest() for t in normalised(batch.column("text"))]
            fps = np.array([_fingerprint(s, bits) for s in shas], np.uint64)
            met.append(fps)
            size = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            n = len(shas)
            yield _batch(schema, n, kind=pa.array([0] * n, pa.int8()), row=batch.column("row"), doc_id=batch.column("doc_id"), n_chars=size, sha=pa.array(shas, pa.binary()), fp=pa.array(fps.astype(np.int64)))
        if met:
            every = np.sort(np.concatenate(met))
            third = np.zeros(len(every), bool)
            third[2:] = every[2:] == every[:-2]
            lists = X.list_frame(TaskContext.get().partitionId(), every[~third], bits, owners)
            yield _batch(schema, len(lists), kind=pa.array([1] * len(lists), pa.int8()), **{c: pa.Array.from_pandas(lists[c], type=schema.field(c).type) for c in lists})

    return run


def _batch(schema: pa.Schema, size: int, /, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (row_id, doc_id, n_chars, text_sha256, keep_id, group_size, kept).

    Texts are equal when their bytes are, after deleting ASCII white space. Of equal texts the row
    with the most code points stays, then the smallest id (null last), then the first row; so exactly
    one of rows that are repeated whole is kept. A null text counts as empty, and all empty texts form
    one class. An empty table gives no rows. Other columns are not read; ``row_col`` names a row number
    if the caller has one.
    """
    spark = docs.sparkSession
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        docs = with_row_id(docs, row_col)
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = docs.count()
    bits = min(62, max(16, n.bit_length() + 10))
    owners = max(spark.sparkContext.defaultParallelism, -(-n // HASHES_PER_OWNER))

    schema = T.StructType.fromDDL(f"kind tinyint, row long, n_chars long, sha binary, fp long, {X.LIST_SCHEMA}").add("doc_id", docs.schema["doc_id"].dataType)
    sent = materialize(docs.mapInArrow(_send(bits, owners, to_arrow_schema(schema)), schema), "digests")
    rows = sent.where("kind = 0").select("row", "doc_id", "n_chars", "sha", "fp")
    lists = sent.where("kind = 1").select("shard", "owner", "n", "low", "code")

    def flagged(batches):
        for b in batches:
            got = [X.open_list(r["owner"], r["n"], r["low"], r["code"], bits, owners)[X.open_bitmap(r["bitmap"], r["n"])] for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(X.distinct(np.concatenate(got)).astype(np.int64) if got else [], pa.int64())], ["fp"])

    replies = X.answer(lists, bits, owners).drop("n")
    suspects = materialize(lists.join(replies, ["shard", "owner"]).mapInArrow(flagged, "fp long").distinct(), "suspects")

    def bodies(batches):
        for b in batches:
            texts = list(normalised(b.column("text")))
            fps = [_fingerprint(hashlib.sha256(t).digest(), bits) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(texts, pa.binary())], ["fp", "body"])

    classes = (
        docs.select("text").mapInArrow(bodies, "fp long, body binary")
        .join(small_enough(suspects), "fp", "left_semi")
        .groupBy("fp", "body").agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("fp", F.unhex(F.sha2("body", 256)).alias("sha"))
    )
    # aggregated before it meets the verified classes, so that a large class is combined map-side
    best = F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = rows.groupBy("fp", "sha").agg(best.alias("best"), F.count("*").alias("size")).where("size > 1")
    keep = groups.join(classes, ["fp", "sha"], "left_semi")
    keep = materialize(keep.select("fp", "sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "size"), "classes")
    single = F.col("size").isNull()
    return rows.join(small_enough(keep), ["fp", "sha"], "left").select(
        F.col("row").alias("row_id"),
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("keep_row") == F.col("row"))).alias("kept"),
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that ``exact_dedup`` keeps."""
    row = fresh_name(docs, "_row")
    docs = numbered(docs, row)
    found = exact_dedup(docs, id_col, text_col, row)
    return drop_rows(docs, row, materialize(found.where(~F.col("kept")).select(F.col("row_id").alias(row)), "copies"))
