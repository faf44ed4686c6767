"""Archive: exact round trip of records, revisits, damaged stores, defined cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import warc
from feedloom.session import shared_dir

PAGES = "page_id long, url string, html string"
LONG = "é" * 60


def archive(spark, rows, **kw):
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).withColumn("size", F.lit("x"))
    folder = shared_dir(spark, "warc-test")
    warc.write(df, folder, **kw)
    return folder


def test_blocks_are_cut_from_records(spark):
    rows = [(1, "http://é/1", LONG), (2, "u", LONG), (3, None, "a\r\n\r\nb" * 30), (4, "u", None), (5, "u", "\r\n\r\n")]
    got = warc.read(spark, archive(spark, rows)).select("record_id", warc.block_of(F.col("record")).alias("block"))
    assert {int(r.record_id): bytes(r.block).decode() for r in got.collect()} == {
        1: LONG, 2: "", 3: "a\r\n\r\nb" * 30, 4: "", 5: "\r\n\r\n"}


def test_records_round_trip(spark):
    rows = [(1, "http://a/1", LONG), (2, "http://a/\r\nX: y", LONG), (3, None, "short"), (4, "u", "short"),
            (5, "u", None), (6, "u", ""), (7, "u", "z" * 200_000)]
    folder = archive(spark, rows)
    got = {int(r["record_id"]): r for r in warc.read(spark, folder).collect()}
    assert len(got) == len(rows)
    for page_id, url, html in rows:
        r, data = got[page_id], (html or "").encode()
        assert bytes(r["payload"]) == data and r["payload_bytes"] == len(data)
        assert r["payload_digest"] == hashlib.sha256(data).hexdigest()
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert rest[:-4] == (b"" if r["record_type"] == "revisit" else data)
        assert int(lines["Content-Length"]) == len(rest) - 4
        assert lines["WARC-Record-ID"] == f"<urn:page:{page_id}>"
        assert "\n" not in lines["WARC-Target-URI"]
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", "1")
    assert {got[i]["record_type"] for i in (1, 3, 4, 5, 6, 7)} == {"response"}
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == 4


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "u", LONG), (3, "u", LONG), (3, "u", LONG), (None, "u", LONG + "b"), (None, "u", LONG + "b")]
    got = [(r["record_id"], r["record_type"], r["refers_to"]) for r in warc.read(spark, archive(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([("3", "response", None)] * 2 + [(None, "revisit", "3")]
                                          + [(None, "response", None)] * 2, key=str)


def test_damaged_payload_fails_the_read(spark):
    folder = archive(spark, [(1, "u", LONG)])
    bad = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit("other").cast("binary")).collect()
    spark.createDataFrame(bad).write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read(spark, folder).collect()


def test_missing_payload_fails_the_read(spark):
    folder = archive(spark, [(1, "u", LONG)])
    spark.createDataFrame([], "digest string, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="no payload"):
        warc.read(spark, folder).collect()


def test_empty_table(spark):
    assert warc.read(spark, archive(spark, [])).collect() == []
