"""Document fingerprints by SimHash, in DataFrame operations only.

A term is a word with the word after it (the last word: alone). Its 64-bit hash votes on each bit of the
fingerprint, for 1 or for 0, with the term's weight; a bit is set if the votes for 1 are the greater part. A weight is
the term's length, so that pairs of short function words, which any text has, say little.

Fingerprints within a Hamming radius are found in permuted block tables: the 64 bits are cut into blocks, and each
choice of ``radius`` blocks is left out of one table's key. Two fingerprints within the radius differ in at most that
many blocks, so some table has them under one key. A key that holds very many fingerprints is dealt again by tables
of finer blocks, under which a key can hold few by construction.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostlake.llm.common import fresh_name, materialize, with_row_id
from frostlake.llm.ordering import followers, ordered, range_of

BITS = 64
#: A weight's upper bound: one run of characters without blanks must not outvote a text.
MAX_WEIGHT = 31
#: Fingerprints under one key beyond which they are dealt again by finer blocks.
SPLIT_AT = 1000
#: Bits that the finer tables leave out of a key, at most: a key holds up to 2 ** FREE_BITS fingerprints.
FREE_BITS = 10

_LANE = 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"), "")


def simhash(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, fp long) for each row of ``texts``, whose ``keys`` must name a row. Null and a text without words have 0.

    Votes are summed in the task that reads the row, in two lanes of 32 bits to a long: a text of up to 2^31
    characters, the most a row can hold, does not fill a lane.
    """
    split = texts.select(*keys, words(F.coalesce(text_col, F.lit(""))).alias("_w"))
    # each word beside the next one; a text without words has one row without either
    terms = split.select(*keys, F.expr("inline_outer(arrays_zip(_w, slice(_w, 2, greatest(size(_w) - 1, 0))))").alias("_a", "_b"))
    size = lambda c: F.coalesce(F.length(c), F.lit(0))
    weight = F.least(size("_a") + size("_b"), F.lit(MAX_WEIGHT)).cast("long")
    terms = terms.select(*keys, F.xxhash64("_a", "_b").alias("_h"), weight.alias("_wt"))
    lanes = F.lit(1 | 1 << _LANE)
    votes = [F.sum(F.shiftrightunsigned("_h", b).bitwiseAND(lanes) * F.col("_wt")).alias(f"_v{b}") for b in range(_LANE)]
    summed = terms.groupBy(*keys).agg(F.sum("_wt").alias("_n"), *votes)
    fp = F.lit(0).cast("long")
    for b in range(BITS):
        ones = F.shiftrightunsigned(f"_v{b % _LANE}", b - b % _LANE).bitwiseAND(F.lit((1 << _LANE) - 1))
        fp = fp.bitwiseOR(F.when(2 * ones > F.col("_n"), F.lit(_signed(1 << b)).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias("fp"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits, 0 to 1."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hexadecimal(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def _masks(blocks: int, left_out: int) -> Column:
    """The key masks of all tables: every choice of blocks to leave out."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    spans = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return F.array(*[F.lit(_signed(((1 << BITS) - 1) ^ sum(chosen))).cast("long") for chosen in combinations(spans, left_out)])


def _dealt(fps: DataFrame, blocks: int, radius: int) -> DataFrame:
    """(mask, key, fp): each fingerprint's place in every table. A table's key is what its mask lets through."""
    return fps.select("fp", F.explode(_masks(blocks, radius)).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def _met(dealt: DataFrame, radius: int) -> DataFrame:
    """(a, b), a < b, under one key and within the radius. Tables may find a pair again."""
    both = dealt.alias("l").join(dealt.alias("r"), ["mask", "key"]).where("l.fp < r.fp")
    return both.where(F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= radius).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_pairs(fps: DataFrame, radius: int, split_at: int = SPLIT_AT) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct ``fp`` of ``fps`` that differ in at most ``radius`` bits, each once."""
    fps = fps.select("fp")
    if radius == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    dealt = _dealt(fps, 2 * radius, radius)
    # most keys hold one fingerprint, and go before anything is joined
    sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(dealt.join(sizes, ["mask", "key"]), "shared-keys")
    met = materialize(_met(shared.where(F.col("n") <= split_at), radius), "near")
    full = materialize(shared.where(F.col("n") > split_at).select("fp").distinct(), "full-keys")
    if not full.isEmpty():
        # any two of a full key that are within the radius meet here
        finer = -(-BITS // max(FREE_BITS // radius, 1))
        met = met.union(materialize(_met(_dealt(full, finer, radius), radius), "near-full"))
    return met.distinct()


def neighbours(nodes: DataFrame, radius: int, split_at: int = SPLIT_AT) -> DataFrame:
    """``nodes`` (fp, n) with ``n_near``: the rows whose fingerprint is within the radius, its own ``n`` among them."""
    pairs = materialize(near_pairs(nodes, radius, split_at), "near-pairs")
    sizes = nodes.select(F.col("fp").alias("other"), F.col("n").alias("more"))
    both = pairs.select(F.col("a").alias("fp"), F.col("b").alias("other")).union(pairs.select(F.col("b"), F.col("a")))
    more = both.join(sizes, "other").groupBy("fp").agg(F.sum("more").alias("more"))
    return nodes.join(more, "fp", "left").select(*nodes.columns, (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_near"))


def _grouped(rows: DataFrame, radius: int) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with (class_id, n_near): the smallest id with that fingerprint, and how many other
    rows have one within the radius."""
    nodes = materialize(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("class_id")), "fingerprint-nodes")
    # a row that is alone needs no join partner
    classes = materialize(neighbours(nodes, radius).where("n_near > 1").drop("n"), "fingerprint-classes")
    found = rows.join(classes, "fp", "left")
    return found.withColumn("class_id", F.when(F.col("n_near").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))).withColumn("n_near", F.coalesce(F.col("n_near") - 1, F.lit(0)).cast("long"))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp long, fingerprint hex, class_id, n_near).

    Equal texts have equal fingerprints; null counts as empty, and a text without words has fingerprint 0. ``class_id``
    is the smallest id (null only if all are null) with the same fingerprint, ``n_near`` the number of other rows
    whose fingerprint differs in at most ``radius`` bits, repeated rows each counted. An empty table gives no rows;
    other columns are not read.
    """
    row = fresh_name(docs, "_row")
    texts = with_row_id(docs, row).select(F.col(row).alias("row"), docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    found = _grouped(materialize(simhash(texts, ["row", "doc_id"]), "fingerprints"), radius)
    return found.select("doc_id", "fp", hexadecimal("fp").alias("fingerprint"), "class_id", "n_near")


def _beside_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, place, following, doc_id, text, next_text), all rows of a range in one partition.

    Rows are ordered by descending id (null last), ties by the text's SHA-256. ``following`` is the next row's
    place; the last row is followed by the first one, a lone row by itself. Texts move twice: into the order, and to the
    task of their range. A range's first text goes to the range before it as well.
    """
    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.sha2("text", 256))
    placed = ordered(rows, [F.col("doc_id").desc_nulls_last(), F.col("tie").asc()], "place", "fingerprint-order").drop("tie")
    ends = materialize(followers(placed, "place"), "fingerprint-ends")
    first = placed.agg(F.min("place")).first()[0]
    ends = ends.select("last", F.coalesce("following", F.lit(first).cast("long")).alias("following"))
    own = placed.select(range_of("place").alias("range"), "place", "place", F.lit(True).alias("own"), "doc_id", "text").toDF("range", "at", "place", "own", "doc_id", "text")
    heads = placed.join(ends, F.col("place") == F.col("following"))
    heads = heads.select(range_of("last").alias("range"), (F.col("last") + 1).alias("at"), "place", F.lit(False).alias("own"), "doc_id", "text")
    along = Window.partitionBy("range").orderBy("at")
    both = own.union(heads).withColumn("following", F.lead("place").over(along)).withColumn("next_text", F.lead("text").over(along))
    return both.where("own").select("range", "place", "following", "doc_id", "text", "next_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """Every document beside an edited text of its own: its last half gives way to the beginning of the next document.

    One row per row of ``docs``: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    class_id, n_near). The last floor(n_chars / 2) characters are replaced by the first as many of the next document, by
    descending id, or by all it has; the last document is followed by the first. ``near_`` is the share of equal bits in the
    fingerprints of the document and of its edited text, or of the next document. For the other columns, nulls,
    ties and repeated rows see ``document_fingerprints`` and ``_beside_next``.
    """
    beside = _beside_next(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    beside = beside.select("range", "place", "following", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.lit(None).cast("string").alias("sha"), "text"), F.struct(F.lit(1).alias("kind"), F.sha2("edited", 256).alias("sha"), F.col("edited").alias("text")))
    keys = ["range", "place", "following", "doc_id", "n_chars"]
    prints = simhash(beside.select(*keys, F.inline(both)), [*keys, "kind", "sha"])
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c))).alias(f"{c}{kind}")
    rows = materialize(prints.groupBy(*keys).agg(of(0, "fp"), of(1, "fp"), of(1, "sha")).withColumnRenamed("fp0", "fp"), "fingerprints")
    nexts = rows.select(F.col("place").alias("following"), F.col("fp").alias("next_fp"))
    found = _grouped(rows.join(nexts, "following"), radius)
    return found.select(
        "doc_id", "n_chars", F.col("sha1").alias("edited_sha256"), hexadecimal("fp").alias("fingerprint"), hexadecimal("fp1").alias("edited_fingerprint"),
        likeness("fp", "fp1").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"), "class_id", "n_near",
    )
