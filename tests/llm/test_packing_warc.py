"""Packing against brute force and a tokenizer; WARC round trips."""

from __future__ import annotations

import base64
import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from frostlake.llm.packing import PATTERN, TokenCounter, best_boundaries, histogram, pack, pack_documents
from frostlake.llm.queries import VOCABULARY
from frostlake.llm.warc import parse_records, read_archive, resolve_revisits, rewrite, write_archive


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "it's", "Ü", "été", "12", "x1", "!?", "\n", "\t", "\x1c", " ", "日本", "🙂", "'", ""]), max_size=20), st.sampled_from([" ", "  ", "", "\n "]))
def test_token_counts_equal_the_tokenizer(counter, words, glue):
    with open(VOCABULARY, "rb") as f:
        ranks = counter.__dict__.setdefault("ranks", {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    encoding = counter.__dict__.setdefault("plain", tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
    text = glue.join(words) + " tail"
    assert counter.count(text) == len(encoding.encode_ordinary(text))


@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_pad_least(found, buckets):
    lengths = np.array(sorted(found))
    counts = np.array([found[x] for x in lengths.tolist()])
    cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in found.items())
    some = [c + (int(lengths[-1]),) for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1].tolist(), k)]
    got = best_boundaries(lengths, counts, lengths * counts, buckets)
    assert len(got) <= buckets and got[-1] == lengths[-1]
    assert cost(got) == min(map(cost, some))


def test_extra_padding_is_below_a_512th(spark, tmp_dir):
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1025, 5000, 300))
    spark.createDataFrame([(int(n),) for n in lengths], "n_tokens int").write.parquet(f"{tmp_dir}/lengths")
    padded = lambda ends: int((np.array(ends)[np.searchsorted(ends, lengths)] - lengths).sum())
    best = best_boundaries(*(x.astype(np.int64) for x in (*np.unique(lengths, return_counts=True), np.unique(lengths) * np.unique(lengths, return_counts=True)[1])), 6)
    binned = best_boundaries(*histogram(spark.read.parquet(f"{tmp_dir}/lengths")), 6)
    assert padded(best) <= padded(binned) < padded(best) + (padded(best) + lengths.sum()) / 512


def test_histogram_is_bounded_and_exact_below_1025(spark, tmp_dir):
    lengths = [0, 1, 1024, 1025, 1026, 1027, 5000, 5001, 10**9, 10**9 - 1]
    spark.createDataFrame([(n,) for n in lengths], "n_tokens long").write.parquet(f"{tmp_dir}/n")
    longest, n, total = histogram(spark.read.parquet(f"{tmp_dir}/n"))
    assert longest.tolist() == [0, 1, 1024, 1026, 1027, 5000, 5001, 10**9]  # pairs to 2048, eights to 8192
    assert n.sum() == len(lengths) and total.sum() == sum(lengths)


@pytest.mark.parametrize("part_rows", [7, 50_000])
def test_pack(spark, tmp_dir, part_rows):
    r = random.Random(1)
    rows = [(i, i % 50 or None, r.choice([0, 3, 3, 3, 17, 18, 400, 90, 5000])) for i in range(500)]
    spark.createDataFrame(rows, "row long, doc_id long, n_tokens long").write.parquet(f"{tmp_dir}/n")
    got = pack(spark.read.parquet(f"{tmp_dir}/n"), buckets=3, budget=1000, part_rows=part_rows).collect()
    assert sorted((x["row"], x["doc_id"], x["n_tokens"]) for x in got) == rows
    batches = {}
    for x in got:
        assert x["padding"] == x["bucket_tokens"] - x["n_tokens"] >= 0
        batches.setdefault((x["bucket"], x["bucket_tokens"], x["batch"]), []).append(x["place"])
    for (bucket, size, batch), places in batches.items():
        fits = max(1, 1000 // size) if size else 1000
        assert sorted(places) == list(range(len(places))) and len(places) <= fits
        if (bucket, size, batch + 1) in batches:
            assert len(places) == fits  # only a bucket's last batch may be partly filled


def test_pack_documents_edge_cases(spark, tmp_dir):
    rows = [(1, None, 0), (2, "", 0), (None, "one two", 0), (None, "one two", 0), (4, "word " * 200_000, 0), (4, "a" * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = pack_documents(docs, VOCABULARY, buckets=2, budget=1000).collect()
    assert len(got) == 6 and sorted(x["n_tokens"] for x in got)[:4] == [0, 0, 2, 2]
    assert pack_documents(docs.limit(0), VOCABULARY).count() == 0


PAGES = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (3, None, "x" * 1000),
    (4, "http://a/ \r\nü", "é" * 499), (5, "http://a/5", "é" * 499), (6, "http://a/6", None), (7, "http://a/7", ""),
    (8, "u", "é" * 500 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (9, "u", "é" * 500 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (None, "u", "x" * 1000), (9, "u", "y" * 2000), (9, "u", "y" * 2000), (10, "u", "z" * 3_000_000),
]


def wanted(pages, least=1000):
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        twins = [j for j, _, h in pages if (h or "").encode() == raw]
        top = max((j for j in twins if j is not None), default=None)
        revisit = len(raw) >= least and i != top
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return out


def test_rewrite(spark, tmp_dir):
    docs = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, row int")
    got = rewrite(docs, f"{tmp_dir}/w").selectExpr("cast(page_id AS long)", "payload_bytes", "payload_digest", "record_type", "cast(refers_to AS long)").collect()
    want = wanted(PAGES)
    twin = want.index((9, 2000, hashlib.sha1(b"y" * 2000).hexdigest(), "response", None))  # a row repeated whole: once a response
    want[twin] = (*want[twin][:3], "revisit", 9)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_archives_hold_payloads_once_under_valid_headers(spark, tmp_dir):
    docs = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(docs, f"{tmp_dir}/w", file_bytes=2000)
    records = resolve_revisits(read_archive(spark, f"{tmp_dir}/w")).collect()
    assert len(spark.read.format("binaryFile").load(f"{tmp_dir}/w").select("path").collect()) > 3
    assert len({r["record_id"] for r in records}) == len(PAGES)
    full = [bytes(r["payload"]) for r in records if r["record_type"] == "response" and len(r["payload"]) >= 1000]
    assert len(full) == len(set(full))
    by_id = {r["record_id"]: r for r in records}
    for r in records:
        if r["record_type"] == "revisit":
            assert r["payload"] is None and by_id[r["refers_to_id"]]["payload_digest"] == r["payload_digest"]
    assert {r["target_uri"] for r in records} >= {"http://a/%20%20%20ü", None}


def test_reader_rejects_damaged_archives():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in parse_records(good * 2)] == [b"abc"] * 2
    for bad in (good.replace(b"abc", b"abcd"), good.replace(b"WARC/", b"WORC/")):
        with pytest.raises(ValueError):
            list(parse_records(bad))


def test_empty_archive(spark, tmp_dir):
    docs = spark.createDataFrame([], "page_id long, url string, html string")
    assert rewrite(docs, f"{tmp_dir}/w").count() == 0
