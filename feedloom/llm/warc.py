"""Content-addressed web archive.

A write makes two tables in the shared folder: ``payloads`` holds each distinct
payload once under its SHA-256 digest with its smallest id, ``records`` the exact header text of
every record.  A read parses the headers, recomputes the digest of every stored
payload and joins both; a payload that is missing or does not match its digest
fails the read.

Of the records with equal payloads of at least ``min_bytes`` bytes, the one with
the smallest id is a ``response`` and the others are ``revisit`` records that
refer to it.  Smaller payloads are ``response`` records each.

Defined cases: a null payload is empty; a null id counts as larger than any
other, and a group of null ids alone is all responses, as are rows that repeat
the smallest id; a null URL is written as an empty one, line breaks in a URL
are percent-encoded; an empty table makes an empty archive; other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 100
#: Fixed values of the record format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def header(page_id: Column, url: Column, digest: Column, size: Column, first: Column,
           revisit: Column, date: str) -> Column:
    """The header text of a record, up to and with its empty line."""
    def urn(c: Column) -> Column:
        return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    safe_url = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")),
                         F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(page_id)),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", safe_url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(first)),
                                 _line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))),
        F.lit(CRLF))


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", date: str = "1970-01-01T00:00:00Z",
          min_bytes: int = MIN_BYTES) -> None:
    """Archive the pages below ``folder``.

    The aggregation combines before its shuffle, so a payload shared by very
    many pages leaves each task once.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first")
                               ).write.parquet(f"{folder}/payloads")

    slim = rows.select("page_id", "url", "digest", F.octet_length("payload").alias("size"))
    # Read back, so that both sides of the join are scans: a digest of very many pages can be split.
    firsts = pages.sparkSession.read.parquet(f"{folder}/payloads").select("digest", "first")
    revisit = ((F.col("size") >= min_bytes) & F.col("first").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("first")))
    (slim.join(firsts, "digest")
     .select("digest", header(F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"),
                              F.col("first"), revisit, date).alias("header"))
     .write.parquet(f"{folder}/records"))


def block_of(record: Column) -> Column:
    """The bytes between an archived record's header and the two line ends after it."""
    ends = len(CRLF + CRLF)
    head = F.octet_length(F.substring_index(record.cast("string"), CRLF + CRLF, 1)) + F.lit(ends)
    return F.substring(record, head + 1, F.octet_length(record) - head - ends)


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract("header", rf"\n{name}: {pattern}\r\n", 1)
    return F.when(found != "", found)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The archived records: parsed fields, full payload, and ``record``, the
    exact bytes of the record as a WARC file would hold them.

    Digest and length are taken from the stored payload where it is scanned;
    columns that a caller leaves out, the payload above all, are not shuffled.
    """
    stored = spark.read.parquet(f"{folder}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))))
    payloads = stored.select(F.col("digest").alias("_key"), checked.alias("payload_digest"),
                             F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload")
    records = spark.read.parquet(f"{folder}/records")
    joined = records.join(payloads, F.col("digest") == F.col("_key"), "left")
    digest = F.coalesce("payload_digest", F.raise_error(
        F.concat(F.lit("no payload for digest "), F.col("digest"))).cast("string"))
    block = F.when(_field("WARC-Type", "(revisit)").isNull(), F.col("payload")).otherwise(
        F.lit("").cast("binary"))
    return joined.select(
        _field("WARC-Record-ID", f"<{ID_PREFIX}([^>]*)>").alias("record_id"),
        _field("WARC-Target-URI", "([^\r]*)").alias("url"),
        digest.alias("payload_digest"), "payload_bytes",
        _field("WARC-Type", "([a-z]+)").alias("record_type"),
        _field("WARC-Refers-To", f"<{ID_PREFIX}([^>]*)>").alias("refers_to"),
        "payload",
        F.concat(F.col("header").cast("binary"), block, F.lit(CRLF + CRLF).cast("binary")).alias("record"))
