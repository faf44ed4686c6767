"""PII: base spans against the plain patterns, trees against the library, defined cases."""

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from feedloom.llm import pii, queries

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            d = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))]
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and sum(doubled) % 10 == 0
                    or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), list(PATTERNS).index(kind), m.end()))
    return ",".join(f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in sorted(out))


def base_of(text):
    spans = sorted((c.start, pii.KINDS.index(c.kind), c.end) for c in pii.base_candidates(text) if c.base)
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@settings(max_examples=2000, deadline=None)
@given(st.text(st.sampled_from("a1 +@.-(é9250"), max_size=40))
def test_base_spans_on_random_texts(text):
    assert base_of(text) == plain_base(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "a.b@c.de", "1.2.3.4", "999.1.1.1", "+1 (559) 555-3817", ".", " ",
                                 "@", "-", "5", "漢", "4111111111111112", "x@y", "1.2.3.4.5.6.7.8", "\n", "٣", "+"]), max_size=8))
def test_base_spans_on_pieces(pieces):
    assert base_of("".join(pieces)) == plain_base("".join(pieces))


def test_query_on_the_table(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_pii(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == base.count(f"{kind}:")
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def fitted(spark):
    texts = [f"mail name{i}@host{i}.example.com or call +1 (555) 555-{1000 + i} now, card 4111 1111 1111 1111, "
             f"ip 10.0.{i % 200}.7, no card 4111 1111 1111 {1112 + i}, no ip 300.1.{i}.5, number 1234 {i}" for i in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df, pii.fit(df)


def test_exported_trees_score_as_the_library(spark, fitted):
    rows = pii.labelled(fitted[0], "text").select("label", "x", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(rows)
    got = model.transform(rows).select("x", vector_to_array("probability")[1].alias("p")).collect()
    scores = pii.exported(model).score(np.array([r["x"] for r in got]))
    assert len(got[0]["x"]) == pii.N_FEATURES
    assert np.allclose(scores, [r["p"] for r in got])


def test_loose_spans_are_scored_and_checked(fitted):
    forest = fitted[1]
    assert forest.trees and set(forest.thresholds) == set(pii.KINDS)
    text = "card 4111.1111.1111.1111, again 4111/1111/1111/1112"
    base, added = pii.detect(text, forest)
    assert base == [] and [(c.kind, c.start, c.end) for c in added] == [("card", 5, 24)]
    kinds = {c.kind for c in pii.loose_candidates("x (at) y (dot) com, 555-123-4567 and fe80::1:2:3")}
    assert kinds == {"email", "phone", "ip"}
    assert pii.redacted(text, [pii.Candidate("card", 5, 24, True, True), pii.Candidate("phone", 10, 24, True, True)]) == (
        "card [card], again 4111/1111/1111/1112")


def test_thresholds():
    bins = [(900, 200, 200.0), (500, 10, 0.0), (400, 10, 10.0)]
    assert pii.calibrated(bins, 0.98) == 0.9
    assert pii.calibrated([(900, 1, 0.0)], 0.98) == float("inf") and pii.calibrated([], 0.98) == float("inf")


FORMS = [("email", "mail {} now", "ann{0}@site{0}.example.com"), ("phone", "call {} now", "+1 (555) 555-{1}"),
         ("card", "card {} paid", "4111 1111 1111 1111"), ("ip", "ip {} down", "10.0.{2}.7")]


def planted(i, loose):
    kind, around, form = FORMS[i % 4]
    span = form.format(i, 1000 + i, i % 200)
    span = pii.loose_form(kind, span) if loose else span
    text = f"some {'words and ' * (i % 5)}more before, " + around.format(span) + f", order 7781{i:04} {i}/2024 room 12.5, version 1.{i}.0 " * 3
    return kind, text, text.index(span), text.index(span) + len(span)


def test_planted_loose_forms_are_found_and_clean_texts_left_alone(spark):
    train = spark.createDataFrame([(planted(i, False)[1],) for i in range(800)], "text string")
    forest = pii.fit(train)
    right = extra = 0
    for i in range(1000, 1200):
        kind, text, start, end = planted(i, True)
        added = [(c.kind, c.start, c.end) for c in pii.detect(text, forest)[1]]
        right += (kind, start, end) in added
        extra += len(added) - ((kind, start, end) in added)
    assert right >= 0.9 * 200 and extra <= 0.1 * right


def test_parts_of_long_digit_runs_are_proposed():
    text = "call 555-100-1000 555-101-1001 555-102-1002 or 9999 4111.1111.1111.1111 0000 1234 5678"
    found = {(c.kind, text[c.start:c.end]) for c in pii.loose_candidates(text)}
    assert {("phone", f"555-10{i}-100{i}") for i in range(3)} | {("card", "4111.1111.1111.1111")} <= found
    local = "a" * 200
    assert pii.loose_candidates(f"x {local} at b dot com")[0].start == 2


def test_many_spans_take_time_in_proportion(fitted):
    forest = pii.Forest(fitted[1].weights, fitted[1].trees, dict.fromkeys(pii.KINDS, 0.0))
    text = " ".join(f"ann{i} at site{i} dot com, b{i}@c.de" for i in range(8000))
    began = time.monotonic()
    base, added = pii.detect(text, forest)
    assert len(base) == 8000 and len(added) >= 8000 and time.monotonic() - began < 5
    taken = pii.Taken((c.start, c.end) for c in base + added)
    assert len(taken.starts) == len(base) + len(added)


def test_a_text_repeated_often_counts_once(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    rows = [r["text"] for r in pii.sampled(df, "text", 200, 0).collect()]
    assert len(rows) == len(set(rows)) and 100 < len(rows) < 320
    assert pii.sampled(df, "text", 10_000, 0).count() == 1001


def test_trees_and_thresholds_come_from_every_distinct_text(spark, monkeypatch):
    texts = [f"order {i} room 555 010 {i:05}" + (f" mail a{i}@b.co" if i % 40 == 0 else "") for i in range(25_000)]
    df = spark.createDataFrame([(t,) for t in texts + texts[:500]], "text string")
    kept, put = [], pii.written
    monkeypatch.setattr(pii, "written", lambda rows, purpose: kept.append(put(rows, purpose)) or kept[-1])
    scored = pii.score_bins
    monkeypatch.setattr(pii, "score_bins", lambda rows, forest: kept.append(rows) or scored(rows, forest))
    assert pii.fit(df).trees
    whole = [e for t in texts for e in pii.examples(t)]
    assert kept[0].count() == len(whole) > 25_000
    assert kept[0].where("label = 1").count() == sum(label for *_, label in whole) == 625
    assert kept[1].count() == kept[0].where("fold = 0").count()


def test_a_text_of_very_many_examples_leaves_in_parts(spark):
    text = " ".join(f"555-{i:03}-{1000 + i}" for i in range(900))
    rows = pii.labelled(spark.createDataFrame([(text,), (None,)], "text string"), "text")
    n = len(list(pii.examples(text)))
    assert n > pii.EXAMPLES and rows.count() == n == rows.select("place").distinct().count()


def test_nulls_long_and_repeated_texts_and_clashing_columns(spark, fitted):
    long = ["1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1" + " " * 100_000, "@" * 50_000, " at " * 30_000,
            "a@" * 40_000, "(at)" * 30_000, "1:" * 50_000, "x@y." * 20_000]
    texts = [None, "", "a@b.co", "a@b.co", *long]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pii", F.lit("own"))
    rows = pii.find(df, fitted[1]).orderBy("doc_id").collect()
    assert [len(r["pii"]) for r in rows[:4]] == [0, 0, 1, 1]
    for text, r in zip(texts, rows):
        want = [s for s in plain_base(text or "").split(",") if s] if len(text or "") < 1000 else None
        assert want is None or [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["pii"] if s["base"]] == want


def test_empty_table_and_nothing_to_learn(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(df, pii.fit(df)).collect() == []
    one = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    forest = pii.fit(one)
    assert forest.trees == [] and len(pii.find(one, forest).first()["pii"]) == 1
