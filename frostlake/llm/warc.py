"""WARC revisit resolution.

Only headers (digest, size, id) are shuffled: by payload digest, to find the original of each group of
equal payloads, and again to join revisit records to their originals. Archives are written by Spark's
text writer, one record a row, so a lost task leaves no half-written file behind; they are read back by
parsing whole archive files, whose size the writer bounds.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostlake.llm.common import fresh_name, materialize, numbered, small_enough

#: Fixed values of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: Payload bytes of an archive file, about; a record is never split.
FILE_BYTES = 16_000_000
RECORD = "record_id string, record_type string, target_uri string, date string, page_id string, payload_digest string, payload_bytes long, refers_to_id string, payload binary"


def _revisits(headers: DataFrame, min_bytes: int) -> DataFrame:
    """(row, original_row, original_id, original_url) of records whose payload another record has."""
    key = ["digest", "sha256", "n_bytes"]
    known = headers.where(F.col("n_bytes") >= min_bytes)
    best = F.max(F.struct("page_id", (-F.col("row")).alias("minus_row"), "url")).alias("best")
    groups = known.groupBy(*key).agg(best, F.count("*").alias("n")).where("n > 1").select(*key, "best")
    pairs = known.select("row", *key).join(groups, key).where("row <> -best.minus_row")
    return pairs.select("row", (-F.col("best.minus_row")).alias("original_row"), F.col("best.page_id").alias("original_id"), F.col("best.url").alias("original_url"))


def _urn(row, page_id) -> F.Column:
    raw = F.md5(F.concat_ws("/", row.cast("string"), page_id.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(raw, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))


def _header(name: str, value) -> F.Column:
    """Null without a value: concat_ws then leaves the line out."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def write_archive(records: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 1000, file_bytes: int = FILE_BYTES) -> None:
    """Write ``records`` as gzipped WARC files under ``path``, equal payloads once.

    Of records with equal payloads (SHA-1, SHA-256 and size) of at least ``min_bytes``, the one with
    the largest id (null smallest, then the first row) is a response and the others are revisits of
    it; all smaller payloads are responses. Each record has fresh headers. A null payload is empty, a
    null id or URL leaves its header out, and blanks and control characters in a URL are
    percent-encoded. An empty table writes an archive without records.
    """
    spark = records.sparkSession
    row = fresh_name(records, "_row")
    records = numbered(records.select(id_col, url_col, payload_col), row)
    clean = F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20\x7f]", "%20")
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    records = records.select(F.col(row).alias("row"), F.col(id_col).alias("page_id"), clean.alias("url"), body.alias("body"))
    headers = records.select("row", "page_id", "url", F.sha1("body").alias("digest"), F.sha2("body", 256).alias("sha256"), F.octet_length("body").cast("long").alias("n_bytes"))
    headers = materialize(headers, "warc-headers")
    revisits = materialize(_revisits(headers, min_bytes), "revisits")
    files = max(1, -(-(headers.agg(F.sum("n_bytes")).first()[0] or 0) // file_bytes))
    date = spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("body").cast("string"), F.lit(CRLF * 2))
    again = F.col("original_row").isNotNull()
    block = F.when(again, http).otherwise(F.concat(http, F.col("body")))
    lines = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.when(again, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        _header("WARC-Record-ID", _urn(F.col("row"), F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        _header("WARC-Target-URI", F.col("url")),
        _header("X-Page-Id", F.col("page_id")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("body"))),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(again, _header("WARC-Refers-To", _urn(F.col("original_row"), F.col("original_id")))),
        F.when(again, _header("WARC-Refers-To-Target-URI", F.col("original_url"))),
        F.when(again, F.lit(f"WARC-Refers-To-Date: {date}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _header("Content-Length", F.octet_length(block)),
    )
    dealt = records.repartition(files, "row").join(small_enough(revisits), "row", "left")
    text = dealt.select(F.concat(lines, F.lit(CRLF * 2), block).alias("value"))
    text.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def parse_records(data: bytes):
    """(headers with lower-case names, block) of each record in an archive file's plain bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {version[:40]!r}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        begin, size = end + 4, int(headers["content-length"])
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"a record's block does not end where its header says, at byte {begin + size}")
        yield headers, data[begin : begin + size]
        at = begin + size + 4


def _plain(content: bytes) -> bytes:
    """The bytes of one or more gzip members."""
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record under ``path``; digest and size of a response are computed from its payload
    and must agree with its header. Revisit records have neither payload nor size yet."""

    def run(batches):
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for h, block in parse_records(_plain(content.as_py())):
                    known = {"record_id": h["warc-record-id"], "record_type": h["warc-type"], "target_uri": h.get("warc-target-uri"), "date": h["warc-date"], "page_id": h.get("x-page-id"), "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"), "refers_to_id": h.get("warc-refers-to")}
                    if known["record_type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if hashlib.sha1(payload).hexdigest() != known["payload_digest"]:
                            raise ValueError(f"payload of {known['record_id']} does not have its digest")
                        known |= {"payload_bytes": len(payload), "payload": payload if payloads else None}
                    rows.append(known)
                types = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` of ``read_archive``, revisits with (refers_to, payload_bytes) of their original.

    refers_to is the original's page id as text. A revisit whose original is not there keeps nulls.
    """
    originals = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), "payload_digest", F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("original_bytes"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    found = revisits.join(originals, ["payload_digest", "refers_to_id"], "left").withColumnRenamed("original_bytes", "payload_bytes")
    return records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("string")).unionByName(found)


def rewrite(records: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """Write the deduplicated archive, read it back and resolve its revisits; no payloads are returned."""
    spark = records.sparkSession
    write_archive(records, path, id_col, url_col, payload_col, min_bytes)
    back = materialize(read_archive(spark, path, payloads=False).drop("payload"), "warc-records")
    return resolve_revisits(back)
