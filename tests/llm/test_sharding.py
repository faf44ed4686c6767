"""Sharding: laws of the result, the permutation and its inverse, defined cases."""

from zlib import crc32

import pytest
from pyspark.sql import functions as F

from feedloom.llm import queries, sharding

DOCS = "doc_id long, text string"


def check_law(rows, n, shards):
    sizes = [0] * shards
    for r in rows:
        sizes[r["shard"]] += 1
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000])
def test_places_are_a_permutation(spark, n):
    at = spark.range(n).select("id", sharding.place(F.col("id"), F.lit(n).cast("bigint"), 7).alias("p"))
    rows = at.withColumn("back", sharding.row_at(F.col("p"), F.lit(n).cast("bigint"), 7)).collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)


def test_order_is_shuffled_and_seeded(spark):
    n = F.lit(500).cast("bigint")
    rows = spark.range(500).select(sharding.place(F.col("id"), n, 1).alias("a"),
                                   sharding.place(F.col("id"), n, 2).alias("b")).collect()
    a, b = [r["a"] for r in rows], [r["b"] for r in rows]
    assert a != b and a != sorted(a)
    assert abs(sum(x % 24 for x in a[:250]) / 250 - 11.5) < 1.5


def test_query_on_the_table(spark, sf):
    rows = queries.op1_sharding(spark, sf).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_law(rows, len(docs), queries.SHARDS)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == crc32(data)


def test_result_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    def result(df):
        return sorted(tuple(r) for r in sharding.shards(df, 24).select("doc_id", "shard", "slot").collect())
    assert result(docs) == result(docs.repartition(7, "text"))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (1, ""), (1, "x"), (2, None), (None, "é" * 50_000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("own")).withColumn("_hash", F.lit(1))
    got = sharding.shards(df, 3).collect()
    check_law(got, len(rows), 3)
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 8 for _, t in rows)
    assert {r["text_crc32"] for r in got if r["size"] == 8} == {0}


def test_empty_table(spark):
    assert sharding.shards(spark.createDataFrame([], DOCS), 24).collect() == []
