"""Syncmers against brute force, invariants of the choice, next documents, defined cases."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import queries, syncmers

DOCS = "doc_id long, text string"


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def mix(*longs):
    """Spark's xxhash64 over longs: each is hashed with the result before as its seed."""
    h = 42
    for x in longs:
        h = xxhash.xxh64_intdigest((x % 2**64).to_bytes(8, "little"), h)
    return signed(h)


def plain_anchors(text):
    pieces = [signed(xxhash.xxh64_intdigest(p.encode(), 42)) for p in re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text or "")]
    out = []
    for i in range(len(pieces) - 4):
        smers = [mix(pieces[j], pieces[j + 1]) for j in range(i, i + 4)]
        if min(smers) in (smers[0], smers[3]):
            out.append((i, mix(smers[0], pieces[i + 2], smers[3])))
    return out or [(0, mix(*pieces))]


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b)


def printed(found):
    return ",".join(f"{h % 2**64:016x}" for h in sorted({h for _, h in found})[:16])


def plain_results(rows):
    rows = sorted(rows)
    out = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text)
        edit = text[:n - n // 2] + following[:n // 2]
        a, e, x = map(plain_anchors, (text, edit, following))
        out.append((doc, n, hashlib.sha256(edit.encode()).hexdigest(), printed(a), printed(e), jaccard(a, e), jaccard(a, x)))
    return out


WORDS = [f"w{i}" for i in range(12)] + ["verylongwordindeed", "é漢", "🙂"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return ["", " \n", "one", "a b c d", "a b c d e", "x" * 100_000, "漢" * 30_000] + [
        " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 300))) for _ in range(60)]


def test_anchors_against_brute_force(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS).select(
        "doc_id", syncmers.anchors(F.col("text")).alias("a")).collect()
    for r in rows:
        assert [tuple(x) for x in r["a"]] == plain_anchors(texts[r["doc_id"]])


def test_choice_is_free_of_context_and_never_far():
    rng = random.Random(9)
    passage = " ".join(rng.choice(WORDS[:12]) for _ in range(200))
    inside = plain_anchors("some words in front of it " + passage + " and some behind")
    own = plain_anchors(passage)
    places = dict((h, p) for p, h in inside)
    assert all(h in places for _, h in own)
    gaps = [b - a for (a, _), (b, _) in zip(own, own[1:])]
    assert max(gaps) <= syncmers.K - syncmers.S


@pytest.mark.parametrize("run", [1, 3, 128])
def test_results_against_brute_force(spark, texts, run):
    rows = list(zip(range(-5, 500, 7), texts))
    df = spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit("own")).withColumn("place", F.lit(0)).repartition(5)
    got = syncmers.compare_with_edits(df, run=run).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == plain_results(rows)


def test_query_on_the_table(spark, sf):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op6_syncmers(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == plain_results(rows)
    likely = [r for r in got if r["n_chars"] > 400]
    assert sum(r["near_edited"] > r["near_next"] for r in likely) > 0.9 * len(likely)


def test_nulls_single_and_repeated_rows(spark):
    one = syncmers.compare_with_edits(spark.createDataFrame([(1, "ab cd ef")], DOCS)).collect()
    assert [tuple(r) for r in one] == plain_results([(1, "ab cd ef")])
    rows = [(None, "first one"), (3, None), (3, None), (5, "x y"), (5, "x y"), (5, "x z")]
    got = syncmers.compare_with_edits(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    assert len({tuple(r) for r in got if r["doc_id"] == 3}) == 1
    assert len({tuple(r) for r in got if r["doc_id"] == 5}) == 2
    first = next(r for r in got if r["doc_id"] is None)
    assert first["edited_sha256"] == hashlib.sha256(b"first").hexdigest()  # the next text is empty


def test_empty_table(spark):
    assert syncmers.compare_with_edits(spark.createDataFrame([], DOCS)).collect() == []
    assert syncmers.anchor_table(spark.createDataFrame([], DOCS)).collect() == []
