"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``documents``; the last returns one row per document with its place in a training batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frostlake.llm.common import materialize
from frostlake.llm.decontaminate import keep_uncontaminated
from frostlake.llm.exact_dedup import keep_distinct
from frostlake.llm.packing import pack_documents
from frostlake.llm.quality import keep_quality
from frostlake.llm.queries import VOCABULARY
from frostlake.llm.simhash_dedup import keep_one_of_each


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, rejects go."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    return keep_distinct(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_of_each(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_tokens, padding, batch, place)."""
    return pack_documents(docs, VOCABULARY, buckets=16, budget=65_536).drop("row")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier and the fingerprints have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
