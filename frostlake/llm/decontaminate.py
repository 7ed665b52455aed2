"""Benchmark decontamination on a distributed positional inverted index.

The index is split by documents: a shard holds some documents, each wholly, laid end to end with a gap
between them, and a posting list (delta-coded positions) for each term that the benchmark uses. A
window is looked up in each shard by intersecting the lists of its terms, shifted by their offsets,
from the globally rarest term on; most windows end at their first, empty list. The same lists give
proximity matches: all distinct terms of a window, in any order, within the window's length plus a slop.

The benchmark is worked off in blocks of bounded size, so neither the driver nor a task holds more
of it than one block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from frostlake.llm.common import drop_rows, fresh_name, materialize, numbered, small_enough, with_row_id

#: A-Z to a-z; 0-9, a-z and all bytes of non-ASCII characters are word characters.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Postings and words of a shard, at about which it is closed.
SHARD_POSTINGS = 2_000_000
SHARD_WORDS = 8_000_000
#: Benchmark characters of a block.
BLOCK_CHARS = 4_000_000
MATCHES = "row long, item_id string, kind string, begin long, end long"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of digits, letters and characters beyond ASCII."""
    return (text or b"").translate(WORD_BYTES).split()


def varint(values: np.ndarray) -> bytes:
    """Seven bits a byte, low first; the top bit says that more follow."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    rest = v >> np.uint64(7)
    while rest.any():
        size += rest > 0
        rest >>= np.uint64(7)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, left = ends - size, size
    while len(v):
        more = left > 1
        out[at] = (v & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        v, at, left = v[more] >> np.uint64(7), at[more] + 1, left[more] - 1
    return out.tobytes()


def unvarint(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    begin = np.r_[0, last[:-1] + 1] if len(last) else last
    out = np.zeros(len(last), np.uint64)
    for k in range(int((last - begin).max()) + 1 if len(last) else 0):
        here = begin + k
        ok = here <= last
        out[ok] |= (raw[here[ok]] & np.uint64(127)).astype(np.uint64) << np.uint64(7 * k)
    return out.astype(np.int64)


class Block:
    """A part of the benchmark: its terms, and its windows as term ids."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.terms: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words_of((text or "").encode("utf-8", "surrogatepass"))]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                self.windows.setdefault(tuple(ids[i : i + size]), set()).add(item)


def _index(terms, gap: int, schema: pa.Schema):
    """Rows of a document (term -1: row, doc_id, n_words, start) and posting rows (term, n, data), by shard."""

    def emit(size, /, **columns):
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def run(batches):
        known = terms.value
        part, count = TaskContext.get().partitionId(), 0
        ids, at, total, held = [], [], 0, 0

        def flush(shard):
            t, p = np.concatenate(ids), np.concatenate(at)
            order = np.argsort(t, kind="stable")
            t, p = t[order], p[order]
            cut = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.empty(0, np.int64)
            ends = np.r_[cut[1:], len(t)]
            data = [varint(np.diff(p[a:b], prepend=0)) for a, b in zip(cut, ends)]
            return emit(len(cut), shard=pa.array(np.full(len(cut), shard)), term=pa.array(t[cut]), n=pa.array(ends - cut), data=pa.array(data, pa.binary()))

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            starts, sizes, shards = [], [], []
            for text in texts:
                words = words_of(text.as_py())
                got = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
                here = np.flatnonzero(got >= 0)
                ids.append(got[here])
                at.append(here + total)
                starts.append(total)
                sizes.append(len(words))
                shards.append((part << 32) + count)
                total += len(words) + gap
                held += len(here)
                if held >= SHARD_POSTINGS or total >= SHARD_WORDS:
                    yield flush((part << 32) + count)
                    ids, at, total, held, count = [], [], 0, 0, count + 1
            n = len(sizes)
            yield emit(n, shard=pa.array(shards, pa.int64()), term=pa.array([-1] * n, pa.int32()), row=batch.column("row"), doc_id=batch.column("doc_id"), n_words=pa.array(sizes, pa.int64()), start=pa.array(starts, pa.int64()))
        if ids:
            yield flush((part << 32) + count)

    return run


def _phrases(lists: dict[int, np.ndarray], window: tuple[int, ...], count: dict[int, int], places: np.ndarray | None = None) -> np.ndarray:
    """Positions at which the window begins; ``places`` are those of the rarest term, if fewer come into question."""
    order = sorted(range(len(window)), key=lambda k: (count[window[k]], k))
    begin = (lists[window[order[0]]] if places is None else places) - order[0]
    for k in order[1:]:
        if not len(begin):
            break
        own = lists[window[k]]
        i = np.searchsorted(own, begin + k)
        i[i == len(own)] = 0
        begin = begin[own[i] == begin + k]
    return begin


def _places(lists: dict[int, np.ndarray], window: tuple[int, ...], count: dict[int, int], span: int) -> np.ndarray:
    """The rarest term's places that have each other term less than ``span`` words away; every phrase and
    every near match holds one."""
    first, *others = sorted(set(window), key=lambda t: (count[t], window.index(t)))
    rare = lists[first]
    for t in others:
        if not len(rare):
            break
        own = lists[t]
        i = np.searchsorted(own, rare - span + 1)
        i[i == len(own)] = 0  # all of own is then below by span or more
        rare = rare[np.abs(own[i] - rare) < span]
    return rare


def _near(lists: dict[int, np.ndarray], window: tuple[int, ...], span: int, rare: np.ndarray) -> np.ndarray:
    """Positions from which all distinct terms of the window occur within ``span`` words, one of them
    there; ``rare`` are the places of ``_places``."""
    begin = []
    for t in set(window):  # a spanning stretch begins at some term, at most span - 1 before the rarest one
        own = lists[t]
        low = np.searchsorted(own, rare - span + 1)
        size = np.searchsorted(own, rare, side="right") - low
        begin.append(own[np.repeat(low - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())])
    begin = np.unique(np.concatenate(begin))
    for t in set(window):
        own = lists[t]
        i = np.searchsorted(own, begin)
        ok = i < len(own)
        ok[ok] = own[i[ok]] < begin[ok] + span
        begin = begin[ok]
    return begin


KINDS = np.array(["phrase", "near"], object)


def _search(block, counts, slop: int | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        windows, count = block.value, counts.value
        docs = pdf[pdf["term"] < 0].sort_values("start")
        starts, rows = docs["start"].to_numpy(np.int64), docs["row"].to_numpy(np.int64)
        own = pdf[pdf["term"] >= 0]
        data = dict(zip(own["term"].astype(int), own["data"]))
        lists: dict[int, np.ndarray] = {}
        names: dict[str | None, int] = {}
        found: list[tuple[int, int, int, np.ndarray]] = []
        for window, items in windows.items():
            if any(t not in data for t in window):
                continue
            for t in window:
                if t not in lists:
                    lists[t] = np.cumsum(unvarint(data[t]))
            rare = None if slop is None else _places(lists, window, count, len(window) + slop)
            if rare is not None and not len(rare):
                continue
            near = () if rare is None else _near(lists, window, len(window) + slop, rare)
            for kind, begin, size in ((0, _phrases(lists, window, count, rare), len(window)), (1, near, len(window) + (slop or 0))):
                if len(begin):
                    found += [(names.setdefault(item, len(names)), kind, size, begin) for item in items]
        return _runs(found, list(names), starts, rows)

    return run


def _runs(found: list[tuple[int, int, int, np.ndarray]], names: list[str | None], starts: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    """MATCHES of windows (item's number, kind, size, places): one row for each run of windows that touch or overlap."""
    times = [len(f[3]) for f in found]
    item, kind, size = (np.repeat(np.array([f[k] for f in found], np.int64), times) for k in range(3))
    begin = np.concatenate([f[3] for f in found]) if found else np.empty(0, np.int64)
    doc = np.searchsorted(starts, begin, side="right") - 1
    row, begin = rows[doc], begin - starts[doc]
    order = np.lexsort((begin, kind, item, row))
    row, item, kind, begin, end = row[order], item[order], kind[order], begin[order], (begin + size)[order]
    other = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (kind[1:] != kind[:-1]) | (begin[1:] > end[:-1])
    first = np.flatnonzero(np.r_[True, other]) if len(row) else np.empty(0, np.int64)
    last = np.maximum.reduceat(end, first) if len(first) else end
    return pd.DataFrame({"row": row[first], "item_id": np.array(names, object)[item[first]] if names else np.empty(0, object), "kind": KINDS[kind[first]], "begin": begin[first], "end": last})


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", size: int = 10, slop: int | None = 2, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): (row, doc_id, n_words) of every row, and where benchmark windows occur.

    A window is ``size`` consecutive words of an item, or all of a shorter item; an item without
    words (null, empty) has none. matches has (row, item_id, kind, begin, end): for kind "phrase" the
    word range [begin, end) of a maximal run of exact windows of that item; for "near" that of
    windows whose distinct words lie within size + slop words in any order (none if ``slop`` is
    null). An item with a null id matches with item_id null; repeated items count once. Null texts
    have no words. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        # each block scans the documents
        docs = numbered(docs.select(id_col, text_col), row_col) if blocks > 1 else with_row_id(docs, row_col)
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType.fromDDL("shard long, term int, n long, data binary, row long, n_words long, start long").add("doc_id", docs.schema["doc_id"].dataType)
    documents, matches = None, None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()  # about BLOCK_CHARS
        block = Block([(r["item"], r["text"]) for r in own], size)
        terms = spark.sparkContext.broadcast(block.terms)
        index = materialize(docs.mapInArrow(_index(terms, size + (slop or 0), to_arrow_schema(schema)), schema), "postings")
        count = {r["term"]: r["n"] for r in index.where("term >= 0").groupBy("term").agg(F.sum("n").alias("n")).collect()}  # the block's terms
        windows = {w: items for w, items in block.windows.items() if all(t in count for t in w)}
        search = _search(spark.sparkContext.broadcast(windows), spark.sparkContext.broadcast(count), slop)
        found = materialize(index.select("shard", "term", "data", "row", "start").groupBy("shard").applyInPandas(search, MATCHES), "matches")
        matches = found if matches is None else matches.union(found)
        documents = documents or index.where("term = -1").select("row", "doc_id", "n_words")
    return documents, matches


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", size: int = 10, slop: int | None = 2, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (row, doc_id, n_words, n_hit, item_ids, near_ids).

    n_hit counts the words inside any exact window, item_ids are the items with exact windows and
    near_ids those with proximity matches, sorted as strings, null ids left out.
    """
    documents, matches = find_matches(docs, benchmark, id_col, text_col, item_col, size, slop, row_col)
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    phrases = matches.where("kind = 'phrase'").select("row", "begin", "end").distinct()
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = phrases.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    ids = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("item_id"))))
    named = matches.groupBy("row").agg(ids("phrase").alias("item_ids"), ids("near").alias("near_ids"))
    found = materialize(named.join(hits, "row", "left"), "hits")
    none = F.array().cast("array<string>")
    return documents.join(small_enough(found), "row", "left").select(
        "row", "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce("near_ids", none).alias("near_ids"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """The rows of ``docs``, all their columns, in which no benchmark window occurs."""
    row = fresh_name(docs, "_row")
    docs = numbered(docs, row)
    found = contamination(docs, benchmark, id_col, text_col, size=size, slop=None, row_col=row)
    return drop_rows(docs, row, materialize(found.where("n_hit > 0").select(F.col("row").alias(row)), "contaminated"))
