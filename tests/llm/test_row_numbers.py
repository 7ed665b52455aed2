"""Numbers of rows when a table's splits change between two scans of it."""

from __future__ import annotations

import pytest

from frostlake.llm import common, decontaminate, exact_dedup, line_dedup, quality, simhash_dedup, suffix_dedup, warc
from frostlake.session import scratch_path

SPLITS = "spark.sql.files.minPartitionNum"


def keep_uncontaminated(spark, docs):
    return decontaminate.keep_uncontaminated(docs, spark.createDataFrame([("i", "alpha beta gamma delta")], "item_id string, text string"), size=4)


def contamination(spark, docs):
    items = [("i", "alpha beta gamma delta"), ("j", "text of document"), ("k", "1 7 1 7 1 7")]
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string"), size=4)
    return found.select("doc_id", "n_words", "n_hit", "item_ids")


def archive(spark, docs):
    path = scratch_path(spark, "warc")
    return warc.rewrite(docs, path, "doc_id", "lang", "text", min_bytes=10).select("page_id", "payload_digest", "record_type", "refers_to")


CASES = {
    "keep_distinct": lambda s, d: exact_dedup.keep_distinct(d),
    "keep_one_of_each": lambda s, d: simhash_dedup.keep_one_of_each(d),
    "keep_quality": lambda s, d: quality.keep_quality(d, s.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"), threshold=0.5),
    "keep_uncontaminated": keep_uncontaminated,
    "contamination": contamination,
    "archive": archive,
    "suffix_dedup": lambda s, d: suffix_dedup.suffix_dedup(d, width=20).drop("row_id"),
    "line_dedup": lambda s, d: line_dedup.line_dedup(d).drop("row_id"),
}


@pytest.mark.parametrize("case", CASES)
def test_new_splits_change_no_result(spark, monkeypatch, tmp_dir, case):
    text = lambda i: f"text of document {i // 2 if i % 5 == 0 else i} " * (1 + i % 7) + ("alpha beta gamma delta" if i % 6 == 0 else f"words {i * i} and {i * 7}")
    rows = [(i, "the same long text of copies in many files" if i % 4 == 1 else text(i), "en") for i in range(60)]
    for k in range(6):  # files of several sizes, which are packed into splits by size
        spark.createDataFrame(rows[k * k : (k + 1) ** 2] if k < 5 else rows[25:], "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/docs")
    docs = lambda: spark.read.parquet(f"{tmp_dir}/docs")
    rows_of = lambda df: sorted((tuple(map(str, x)) for x in df.collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)
    spark.conf.set(SPLITS, "1")
    try:
        wanted = rows_of(CASES[case](spark, docs()))
        real = common.materialize

        def then_other_splits(*args):
            out = real(*args)
            spark.conf.set(SPLITS, "12")
            return out

        spark.conf.set(SPLITS, "1")
        for module in (common, decontaminate, exact_dedup, line_dedup, quality, simhash_dedup, suffix_dedup, warc):
            monkeypatch.setattr(module, "materialize", then_other_splits)
        assert rows_of(CASES[case](spark, docs())) == wanted
    finally:
        spark.conf.unset(SPLITS)
