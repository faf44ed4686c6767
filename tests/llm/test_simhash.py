"""SimHash against brute force: fingerprints, links within three bits, components."""

import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import graph, queries, simhash


def plain_fingerprint(text):
    import re
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps):
    """{fp: smallest fp reachable over links of three bits}"""
    root = {f: f for f in fps}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(fps), 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {f: find(f) for f in fps}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def cluster(rng, n, flips):
    center = rng.getrandbits(64)
    out = {center}
    while len(out) < n:
        x = rng.choice(sorted(out))
        for _ in range(rng.randint(1, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


@pytest.mark.parametrize("limit", [2, 10_000])
def test_components_of_clusters(spark, limit):
    """Small posting lists make pairs, long ones points; both give the same components."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(50)} | {0, 2**64 - 1, 1, 7, 15}
    for flips in (1, 3, 5):
        fps |= cluster(rng, 30, flips)
    fps = {signed(f) for f in fps}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in graph.components(simhash.links(df, limit)).collect()}
    want = plain_components(fps)
    assert {f: got.get(f, f) for f in fps} == want


def test_ball_has_every_point_once(spark):
    row = spark.range(1).select(simhash.ball(F.lit(-5).cast("long"), 2).alias("two"),
                                simhash.ball(F.lit(-5).cast("long"), 1).alias("one")).first()
    assert len(row["two"]) == len(set(row["two"])) == 1 + 64 + 2016
    assert len(row["one"]) == len(set(row["one"])) == 65
    assert all(bin((z ^ -5) & (2**64 - 1)).count("1") <= 2 for z in row["two"])


@pytest.mark.parametrize("edges, want", [
    ([], {}),
    ([(5, 5)], {}),
    ([(i, i + 1) for i in range(200)], {i: 0 for i in range(201)}),
    ([(7, i) for i in range(8, 60)] + [(60, 61)], {**{i: 7 for i in range(7, 60)}, 60: 60, 61: 60}),
])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r["node"]: r["root"] for r in graph.components(df).collect()} == want


def test_query_on_the_table(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {d: plain_fingerprint(t) for d, t in docs.items()}
    roots = plain_components({signed(f) for f in fps.values()})
    first = {}
    for d in sorted(docs):
        first.setdefault(roots[signed(fps[d])], d)
    rows = queries.op10_simhash(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == first[roots[signed(fps[r["doc_id"]])]]


def test_nulls_short_long_and_repeated_texts(spark):
    texts = [None, "", " \t\n", "One", "one", "one two", "ÉCOLE", "école", "w " * 150_000, "w w w", "w w w w"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "One"), (None, "alone"), (3, "One")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("own")).withColumn(
        "component_id", F.lit(0))
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert all(signed(plain_fingerprint(t)) == r["fp"] for r in got for t in [dict(rows).get(r["doc_id"])]
               if r["doc_id"] not in (None, 3))
    of = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert (of[0], of[1], of[2], of[3], of[4], of[6], of[7]) == (0, 0, 0, 3, 3, 6, 7)
    assert of[8] == of[9] == of[10] == 8
    assert sorted(str(r["component_id"]) for r in got if r["doc_id"] is None) == ["3", "None"]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
