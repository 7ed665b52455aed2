"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.llm.chat import format_chats
from frostlake.llm.conversation_repair import read_out, repair_conversations
from frostlake.llm.decontaminate import contamination
from frostlake.llm.exact_dedup import exact_dedup
from frostlake.llm.fingerprints import edited_fingerprints
from frostlake.llm.licenses import license_scan
from frostlake.llm.line_dedup import line_dedup
from frostlake.llm.merkle import digest, manifest, proof
from frostlake.llm.packing import pack_documents
from frostlake.llm.quality import classify
from frostlake.llm.simhash_dedup import simhash_dedup
from frostlake.llm.suffix_dedup import suffix_dedup
from frostlake.llm.warc import rewrite
from frostlake.session import scratch_path

#: A byte-level vocabulary for many languages; the folder is the same on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY, buckets=16, budget=65_536).drop("row")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rewrite(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), min_bytes=1000)
    return found.select(
        F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10, slop=2)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_table(spark, sf_dir, "conversations"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).drop("row_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_table(spark, sf_dir, "documents"), width=50)
    cut = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_bytes", cut.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(_table(spark, sf_dir, "documents"), max_bits=None, similarity=0.8)
    return found.select("doc_id", "n_lines", "n_dropped", "kept_text")


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"), radius=3)


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, chosen by the CRC-32 of each turn's id and number."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = (F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20).alias("fault")
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    steps, overview = repair_conversations(damaged(turns))
    every = turns.select("conv_id").distinct().alias("e")
    o, r = overview.alias("o"), read_out(steps).alias("r")
    same = lambda t: F.col("e.conv_id").eqNullSafe(F.col(f"{t}.conv_id"))
    found = every.join(o, same("o"), "left").join(r, same("r"), "left")
    counts = [F.coalesce(f"o.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("e.conv_id", *counts, F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("r.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claims = {"text": F.when(tampered, lowered).otherwise(F.col("text"))}
    found = manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], claims=claims)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_packing": op2_packing,
        "op3_warc": op3_warc,
        "op4_decontamination": op4_decontamination,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_license_scan": op7_license_scan,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_quality": op9_quality,
        "op10_line_dedup": op10_line_dedup,
        "op11_document_fingerprints": op11_document_fingerprints,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    from frostlake.llm import oracle

    return oracle.oracle_sql()
