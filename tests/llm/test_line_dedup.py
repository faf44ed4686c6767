"""Line dedup against SQL and against plain sets, defined cases."""

import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from feedloom.llm import line_dedup, queries

DOCS = "doc_id long, text string, source string"


def plain(rows, min_sites):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            sites[line.strip(line_dedup.BLANKS)].add(site or "")
    wide = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for doc, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        bare = [x.strip(line_dedup.BLANKS) for x in lines]
        left = [x for x, b in zip(lines, bare) if b not in wide]
        cut = any(b and b not in wide for b in bare) and len(left) < len(lines)
        out.append((doc, "\n".join(left) if cut else text, len(lines), len(lines) - len(left) if cut else 0))
    return sorted(out, key=str)


def deduped(spark, rows, min_sites):
    df = spark.createDataFrame(rows, DOCS).withColumn("_r1", F.lit("own")).withColumn("_marks", F.lit(0)).withColumn(
        "n_lines", F.lit(-1))
    got = line_dedup.dedup_lines(df, min_sites=min_sites)
    assert got.columns == ["doc_id", "text", "source", "_r1", "_marks", "n_lines", "n_removed"]
    return sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(f"select doc_id, n_lines, n_removed, text from ({queries.ORACLES['op8_line_dedup']})").fetchall()
    got = queries.op8_line_dedup(spark, sf).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_around_the_threshold(spark):
    """Spreads from far below to far above, each decided exactly."""
    rng = random.Random(3)
    rows = [(i, f"line {n}\n own {i}\r\n\n", f"s{s}") for i, (n, s) in enumerate(
        (n, s) for n in range(1, 60) for s in rng.sample(range(200), n))]
    assert deduped(spark, rows, 30) == plain(rows, 30)


def test_nulls_blanks_repeats_and_whole_copies(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x\ny", "a"), (None, "x\ny", "a"), (3, " x \nz\nx", "b"),
            (4, "x", "c"), (5, "x\n\t\n", None), (6, "\n\n", "b"), (7, "x\nq" + "é" * 100_000, "d"),
            (8, "x\ny", None), (9, "new\n" * 3000 + "x", "e")]
    assert deduped(spark, rows, 3) == plain(rows, 3)


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).collect() == []
