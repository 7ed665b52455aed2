"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded; gated attention, learnt from document labels
alone, weighs the passages, and the weighted passage representation is scored. Features and scoring
run in Spark tasks over whole texts, a passage at a time. Only the fit sees a sample, bounded by
``max_bags`` labelled documents and ``max_passages`` of their passages (``train``).
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostlake.llm.common import drop_rows, fresh_name, materialize, numbered, with_row_id

#: Bytes of a passage, about; it ends with a word (a longer word is cut).
PASSAGE_BYTES = 1500
#: Passages that are encoded and weighed at a time.
STEP = 512
#: Word shapes that are counted by hash, and byte classes that are counted by themselves.
SHAPES = 64
_MARKS = b"!?.,;:|*#$%&@<>{}[]()/\\_-+=~^`'\""
DIM = SHAPES + len(_MARKS) + 12

#: Each byte's class in a word's shape.
_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)


def passages(text: bytes, size: int = PASSAGE_BYTES):
    """The whole text in passages of about ``size`` bytes; an empty text is one empty passage."""
    at = 0
    while True:
        end = at + size
        if end < len(text):
            stop = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            end = stop + 1 if stop > at else end
        yield text[at:end]
        at = end
        if at >= len(text):
            return


def features(passage: bytes) -> np.ndarray:
    """Word shapes by hash, marks by frequency, and how words repeat, of one passage."""
    out = np.zeros(DIM, np.float32)
    counts = np.bincount(np.frombuffer(passage, np.uint8), minlength=256)
    n = max(1, len(passage))
    words = passage.split()
    m = max(1, len(words))
    for shape, k in Counter(passage.translate(_SHAPE).split()).items():
        out[zlib.crc32(_squeezed(shape)) % SHAPES] += k
    out[:SHAPES] = np.sqrt(out[:SHAPES] / m)
    out[SHAPES : SHAPES + len(_MARKS)] = np.sqrt(counts[list(_MARKS)] / n)
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in passage.split(b"\n") if x]
    out[SHAPES + len(_MARKS) :] = (
        counts[65:91].sum() / n, counts[97:123].sum() / n, counts[48:58].sum() / n, counts[128:].sum() / n,
        counts[32] / n, counts[10] / n * 10, distinct / m, again / m,
        size.mean() / 10, size.std() / 10, len(set(lines)) / max(1, len(lines)), np.log1p(len(words)) / 6,
    )
    return out


def _squeezed(shape: bytes) -> bytes:
    """A shape with runs of one class as one letter: Abc,, becomes Aa,"""
    return bytes(b for i, b in enumerate(shape[:24]) if not i or b != shape[i - 1])


@dataclass
class Model:
    """tanh encoder, gated attention (tanh times sigmoid) and a logistic score."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and attention logit of each passage."""
        w = self.w
        h = np.tanh(((x - self.mean) * self.scale) @ w["e"] + w["be"])
        a = (np.tanh(h @ w["v"]) / (1 + np.exp(-(h @ w["u"])))) @ w["a"]
        return h, a

    def score(self, text: bytes) -> float:
        """Weighted over all passages with a running maximum, so a very long text is read in steps."""
        top, weight, rep = -np.inf, 0.0, 0.0
        held: list[np.ndarray] = []

        def take(top, weight, rep):
            h, a = self.encode(np.stack(held))
            new = max(top, a.max())
            e = np.exp(a - new)
            keep = np.exp(top - new)
            return new, weight * keep + e.sum(), rep * keep + e @ h

        for p in passages(text):
            held.append(features(p))
            if len(held) == STEP:
                top, weight, rep = take(top, weight, rep)
                held = []
        if held:
            top, weight, rep = take(top, weight, rep)
        z = rep / weight @ self.w["c"] + self.w["bc"]
        return float(1 / (1 + np.exp(-z[0])))


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 32, attention: int = 16, epochs: int = 40, batch: int = 64, rate: float = 5e-3, seed: int = 7) -> Model:
    """Adam on the mean log loss of documents; classes weigh by the square root of their rarity."""
    r = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), 1 / (every.std(0) + 1e-3)
    w = {
        "e": r.normal(0, 1 / np.sqrt(DIM), (DIM, hidden)), "be": np.zeros(hidden),
        "v": r.normal(0, 1 / np.sqrt(hidden), (hidden, attention)), "u": r.normal(0, 1 / np.sqrt(hidden), (hidden, attention)),
        "a": r.normal(0, 1 / np.sqrt(attention), attention), "c": r.normal(0, 1 / np.sqrt(hidden), (hidden, 1)), "bc": np.zeros(1),
    }
    y = np.asarray(labels, float)
    share = np.clip([1 - y.mean(), y.mean()], 1e-6, 1)
    cost = np.where(y > 0, np.sqrt(0.5 / share[1]), np.sqrt(0.5 / share[0]))
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(bags))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            x = (np.concatenate([bags[i] for i in own]) - mean) * scale
            size = np.array([len(bags[i]) for i in own])
            begin, of = np.cumsum(size) - size, np.repeat(np.arange(len(own)), size)
            h = np.tanh(x @ w["e"] + w["be"])
            tv, su = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
            logit = (tv * su) @ w["a"]
            ex = np.exp(logit - np.maximum.reduceat(logit, begin)[of])
            alpha = ex / np.add.reduceat(ex, begin)[of]
            rep = np.add.reduceat(alpha[:, None] * h, begin)
            p = 1 / (1 + np.exp(-(rep @ w["c"] + w["bc"])[:, 0]))
            dz = (p - y[own]) * cost[own] / len(own)
            g = {"c": rep.T @ dz[:, None], "bc": np.array([dz.sum()])}
            drep = dz[:, None] * w["c"].T
            dalpha = (drep[of] * h).sum(1)
            dlogit = alpha * (dalpha - np.add.reduceat(alpha * dalpha, begin)[of])
            g["a"] = (tv * su).T @ dlogit
            dgate = dlogit[:, None] * w["a"]
            dv, du = dgate * su * (1 - tv**2), dgate * tv * su * (1 - su)
            g["v"], g["u"] = h.T @ dv, h.T @ du
            dh = (alpha[:, None] * drep[of] + dv @ w["v"].T + du @ w["u"].T) * (1 - h**2)
            g["e"], g["be"] = x.T @ dh, dh.sum(0)
            step += 1
            for k in w:
                grad = g[k] + 1e-4 * w[k]
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad**2
                w[k] = w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean.astype(np.float32), scale.astype(np.float32), {k: v.astype(np.float32) for k, v in w.items()})


def fold(id_col) -> F.Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_bags: int = 4000, max_passages: int = 60_000) -> Model | None:
    """Fit on labelled documents outside fold 0: at most ``max_bags``, the first by hash of their id.

    Of these, documents are taken in that order if they fit into what is left of ``max_passages``, and
    skipped otherwise. A class that gets none this way (it is rare, or its documents are too long) is
    stood for by its first document by hash, of which at most half of ``max_passages`` are used, spread
    evenly. So the driver's share is bounded: ``max_bags`` documents and two more, twice ``max_passages``.
    Rows without id, label or text are left out, as is an id whose labels disagree. Null if either class
    has no document; an error if ``max_passages`` is less than 2.
    """
    if max_passages < 2:
        raise ValueError("with less than 2 passages, a class may have none among the training sample")
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    marks = marks.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    ids = known.select("doc_id").distinct().join(marks, "doc_id")
    by_hash = F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id")
    first = ids.groupBy("label").agg(F.min(by_hash).alias("first")).select("first.doc_id", "label")
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_bags).union(first).distinct()
    chosen = materialize(chosen, "training-ids")
    texts = known.join(F.broadcast(chosen), "doc_id")  # at most max_bags + 2 rows

    def encode(batches):
        for b in batches:
            bags = [np.stack([features(p) for p in passages(t.as_py() or b"")]) for t in b.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array([len(x) for x in bags], pa.int32()), pa.array([x.astype("<f4").tobytes() for x in bags], pa.binary())], ["doc_id", "label", "n", "bag"])

    schema = T.StructType([*texts.select("doc_id", "label").schema, T.StructField("n", T.IntegerType()), T.StructField("bag", T.BinaryType())])
    encoded = materialize(texts.select("doc_id", "label", "text").mapInArrow(encode, schema), "bags")
    once = encoded.groupBy("doc_id").agg(F.min(F.struct("n", "label", "bag")).alias("b")).select("doc_id", "b.*")  # a repeated id's first text
    once = materialize(once, "training-bags")
    left, taken, stand_ins = max_passages, [], {}
    for x in once.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "n", "label").collect():  # at most max_bags + 2 rows
        if x["n"] <= left:
            left -= x["n"]
            taken.append((x["doc_id"], len(taken), x["n"]))
            stand_ins[x["label"]] = None
        else:
            stand_ins.setdefault(x["label"], x["doc_id"])
    taken += [(doc_id, len(taken) + i, max_passages // 2) for i, doc_id in enumerate(stand_ins.values()) if doc_id is not None]
    places = docs.sparkSession.createDataFrame(taken, T.StructType([once.schema["doc_id"], T.StructField("place", T.IntegerType()), T.StructField("most", T.IntegerType())]))

    def thin(batches):
        for b in batches:
            bags = []
            for bag, n, most in zip(b.column("bag").to_pylist(), b.column("n").to_pylist(), b.column("most").to_pylist()):
                some = np.arange(most) * n // most  # spread over the whole text
                bags.append(bag if n <= most else np.frombuffer(bag, "<f4").reshape(n, -1)[some].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("label"), pa.array(bags, pa.binary())], ["place", "label", "bag"])

    used = once.join(F.broadcast(places), "doc_id").select("place", "label", "n", "most", "bag")
    used = used.mapInArrow(thin, T.StructType([used.schema["place"], used.schema["label"], used.schema["bag"]]))
    rows = used.orderBy("place").select("label", "bag").collect()
    y = np.array([x["label"] for x in rows])
    if not len(y) or y.min() == y.max():
        return None
    return fit([np.frombuffer(x["bag"], "<f4").reshape(-1, DIM) for x in rows], y)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(row, doc_id, score) of every row: 0 to 1, higher for label 1; null and empty texts are scored as
    one empty passage. Without a model (no labels to learn from) every score is 1: nothing is rejected."""
    if row_col is None:
        row_col = fresh_name(docs, "_row")
        docs = with_row_id(docs, row_col)
    docs = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return docs.select("row", "doc_id", F.lit(1.0).alias("score"))

    def run(batches):
        for b in batches:
            got = [model.score(t.as_py() or b"") for t in b.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(got, pa.float64())], ["row", "doc_id", "score"])

    return docs.mapInArrow(run, T.StructType([*docs.select("row", "doc_id").schema, T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; predicted is 1 from ``threshold`` on."""
    found = score(docs, train(docs, labels))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all their columns, that are predicted 1. Texts are scored where they lie:
    the verdicts are a column beside each row's number, and only rejected numbers are joined."""
    row = fresh_name(docs, "_row")
    docs = numbered(docs, row)
    found = score(docs, train(docs, labels), row_col=row)
    return drop_rows(docs, row, materialize(found.where(F.col("score") < threshold).select(F.col("row").alias(row)), "rejected"))
