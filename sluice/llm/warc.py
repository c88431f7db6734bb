"""WARC archives and revisit resolution.

Archives are written by Spark's text writer, a record per line with the line
separator CRLF CRLF that ends every WARC record, so the files hold
WARC/1.1 bytes, appear only when their task commits, and no task holds more
than a record. All records of an archive set name its warcinfo id right after
the version line. That id is drawn when the set is written, so no payload
holds it, and version line plus id separate records for Spark's text reader;
the length that a record states is checked against its bytes. Files are gzipped.

Resolution shuffles headers only: the largest (page id, record id) for each
payload digest (combined before the shuffle, so a digest that a third of all
records share is no hot key), joined back to the headers, whose skewed
partitions AQE splits. Payloads move once, by record id, into the deduplicated
archive.

Defined cases: a null payload is empty; a null page id counts as smaller than
any other; of records equal in payload and page id one (by record id) is the
response and the others revisit it; a null url gives a record without target;
line breaks in a url are percent-encoded; an empty table gives an empty archive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

END = "\r\n\r\n"
# Fixed values of the WARC/1.1 format.
VERSION = "WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 SHA-1: 20 bits are five hexadecimal or four base32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 40, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _separator(archive_id: str) -> str:
    return f"{VERSION}WARC-Warcinfo-ID: <urn:uuid:{archive_id}>\r\n"


def _header(heads: Column, name: str, before: str = "", after: str = "") -> Column:
    """The first value of a header field, null where there is none."""
    return F.nullif(F.regexp_extract(heads, rf"(?m)^{name}: {before}([^\r\n]*?){after}$", 1), F.lit(""))


def _http_head(length: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    length.cast("string"), F.lit(END))


def write_archive(records: DataFrame, path: str) -> str:
    """Write ``record_id, page_id, url, payload, payload_bytes, payload_digest,
    record_type, refers_to_record, refers_to`` as WARC files; returns the id
    of the archive set. Revisits get the HTTP head only."""
    archive_id = str(uuid.uuid4())
    http = _http_head(F.col("payload_bytes"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    length = F.octet_length(http) + F.octet_length(body)

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    record = F.concat(
        F.lit(_separator(archive_id)),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("refers_to_record"), F.lit(">"))),
        line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), length.cast("string"), F.lit(END), http, body)
    records.select(record.alias("value")).write.option("lineSep", END).mode("errorifexists").text(path, compression="gzip")
    return archive_id


def read_archive(spark: SparkSession, path: str, archive_id: str) -> DataFrame:
    """Records of an archive set: header fields and payload. A record whose
    bytes do not have the length it states is an error."""
    lines = spark.read.option("lineSep", _separator(archive_id)).text(path)
    # What stands before the first separator of a file is an empty line.
    lines = lines.filter("value <> ''")
    value = F.col("value")
    # The WARC head and the HTTP head; only these short texts are searched.
    heads = F.substring_index(value, END, 2)
    lines = lines.select("value", F.translate(heads, "\r", "").alias("heads"), F.length(heads).alias("n_heads"),
                         (F.octet_length("value") - F.octet_length(F.substring_index(value, END, 1)) - 2 * len(END))
                         .alias("n_block"))
    heads = F.col("heads")
    http_length = F.regexp_extract(heads, r"(?s)\nContent-Length: .*\nContent-Length: (\d+)", 1).cast("long")
    id_ends = {"before": "<urn:uuid:", "after": ">"}
    return lines.select(
        _header(heads, "WARC-Record-ID", **id_ends).alias("record_id"),
        _header(heads, "WARC-Type").alias("record_type"),
        _header(heads, "WARC-Target-URI").alias("url"),
        _header(heads, "X-Page-ID").cast("long").alias("page_id"),
        _header(heads, "WARC-Payload-Digest", before="sha1:").alias("payload_digest"),
        F.when(F.col("n_block") == _header(heads, "Content-Length").cast("long"), http_length).otherwise(
            F.raise_error(F.lit("a WARC record has not the length it states"))).alias("payload_bytes"),
        _header(heads, "WARC-Refers-To", **id_ends).alias("refers_to_record"),
        _header(heads, "X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.substring(value, F.col("n_heads") + len(END) + 1, F.length(value) - F.col("n_heads") - 2 * len(END))
        .alias("payload"))


def resolve(headers: DataFrame, min_bytes: int) -> DataFrame:
    """``record_id, record_type, refers_to_record, refers_to``: of the headers
    ``record_id, page_id, payload_bytes, payload_digest`` with equal payloads
    of at least ``min_bytes`` bytes the largest page id answers, the others
    revisit it."""
    key = ["payload_digest", "payload_bytes"]
    path = scratch_path(headers.sparkSession, "responses")       # written, so that AQE can split the join below
    (headers.groupBy(*key).agg(F.max(F.struct("page_id", "record_id")).alias("best"), F.count("*").alias("n"))
     .filter("n > 1").drop("n").write.parquet(path))
    best = headers.sparkSession.read.parquet(path)
    revisit = (F.col("best.record_id") != F.col("record_id")) & (F.col("payload_bytes") >= min_bytes)
    return headers.join(best, key, "left").select(
        "record_id",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("best.record_id")).alias("refers_to_record"),
        F.when(revisit, F.col("best.page_id")).alias("refers_to"))


def archive_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write a response record for each page."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.expr("uuid()").alias("record_id"), F.col(f"`{page_id}`").cast("long").alias("page_id"),
                        F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       sha1_base32(F.col("payload").cast("binary")).alias("payload_digest"),
                       F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to_record"),
                       F.lit(None).cast("long").alias("refers_to"))
    return write_archive(rows, path)


def deduplicate(spark: SparkSession, path: str, archive_id: str, out: str, min_bytes: int = 0) -> str:
    """Write an archive set again with revisits in place of repeated payloads."""
    records = read_archive(spark, path, archive_id).drop("record_type", "refers_to_record", "refers_to")
    decided = resolve(records.drop("payload", "url"), min_bytes)
    return write_archive(records.join(decided, "record_id"), out)


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``found``: whether a revisit's response is in the archive.
    The responses are unique by id; a response with very many revisits is a
    skewed partition of the join, which AQE splits."""
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload_digest").alias("found_digest"))
    return records.join(responses, "refers_to_record", "left").withColumn(
        "found", F.col("found_digest") == F.col("payload_digest"))


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "warc-dedup")
    archive_id = deduplicate(spark, first, archive_pages(pages, first), second)
    found = resolved(read_archive(spark, second, archive_id).drop("payload", "url"))
    refers = F.when(F.col("found"), F.col("refers_to")).otherwise(
        F.raise_error(F.lit("a revisit record names no response")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type",
                        F.when(F.col("record_type") == "revisit", refers).alias("refers_to"))


# The archive is written and read back by Spark; its rows are the pages'.
OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT *, list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * j AS INT)) & 31 AS INT) + 1, 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS last_id
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM d
"""
