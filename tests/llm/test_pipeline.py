"""The pipeline against its stages' brute force, and its edge cases."""

from __future__ import annotations

import pytest

import corpus_pipeline
from frostlake.llm.quality import classify
from tests.llm.test_pair_operators import brute_exact, brute_fingerprint, brute_hits, components

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in classify(docs, labels).collect() if r["predicted"]}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good]
    first = {k for _, k, *_ in brute_exact(rows)}
    rows = [r for r in rows if r[0] in first]
    fps = {i: brute_fingerprint(t) for i, t in rows}
    part = components(fps.values(), 2)
    first = {}
    for i in sorted(fps):
        first.setdefault(part[fps[i]], i)
    rows = [r for r in rows if r[0] in set(first.values())]
    want = {i for i, t in rows if not brute_hits(t, items)[1]}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    assert 0 < len(want) < docs.count()
    batches = {}
    for r in got:
        batches.setdefault((r["bucket"], r["bucket_tokens"], r["batch"]), []).append(r["place"])
    assert all(sorted(p) == list(range(len(p))) and (len(p) == 1 or len(p) * size <= 65_536) for (_, size, _), p in batches.items())


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "")]])
def test_stages_keep_columns_and_take_odd_rows(spark, tmp_dir, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 7, 8) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row long, _row long")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.collect()
    assert corpus_pipeline.STAGES[1][1](spark, docs, SF).count() == (2 if rows else 0)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)
