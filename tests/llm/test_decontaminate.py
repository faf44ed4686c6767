"""Greedy string tiling against a plain version, reordered passages, defined cases."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, queries

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_coverage(doc, item, least):
    """Greedy string tiling as it is defined: mark a longest unmarked match until none is left."""
    free_d, free_i = [True] * len(doc), [True] * len(item)
    marked = 0
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while (d + n < len(doc) and p + n < len(item) and doc[d + n] == item[p + n]
                       and free_d[d + n] and free_i[p + n]):
                    n += 1
                best = max(best, (n, -d, -p))
        n, d, p = best[0], -best[1], -best[2]
        if n < least:
            return marked / len(item)
        free_d[d:d + n] = [False] * n
        free_i[p:p + n] = [False] * n
        marked += n


@pytest.mark.parametrize("pairs", [decontaminate.PAIRS, 0])
@pytest.mark.parametrize("seed", range(25))
def test_coverage_against_plain_tiling(seed, pairs, monkeypatch):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    rng = random.Random(seed)
    item = [rng.choice("abcdefgh"[:rng.randint(2, 8)]) for _ in range(rng.randint(3, 30))]
    doc = [rng.choice("abcdefgh") for _ in range(10)]
    for _ in range(rng.randint(1, 5)):
        a = rng.randrange(len(item))
        doc[rng.randrange(len(doc)):0] = item[a:a + rng.randint(1, 15)]
    got = decontaminate.Items([(1, " ".join(item))], 3).hits(" ".join(doc), 0.0)
    assert (got[0]["coverage"] if got else 0.0) == pytest.approx(plain_coverage(doc, item, 3))


@pytest.mark.parametrize("seed", range(40))
def test_running_tiles_are_the_listed_ones(seed):
    rng = random.Random(seed)
    item = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 60))]
    doc = [rng.choice("abcd") for _ in range(rng.randint(0, 40))] + item[rng.randrange(len(item)):] * rng.randint(0, 3)
    items = decontaminate.Items([(1, " ".join(item))], 3)
    ids = np.array([items.number.get(w, -1) for w in doc], np.int64)
    at, parts, found = items.shared(ids)
    listed = decontaminate.tiles(items.matches(ids, at, parts[0], 0), 3) if len(found) else []
    assert decontaminate.running_tiles(ids, items.words[0], 3) == listed


def test_equal_hashes_of_unequal_words_are_no_match(monkeypatch):
    monkeypatch.setattr(decontaminate, "BASE", np.uint64(1))
    item, doc = np.array([0, 1, 2, 3, 4]), np.array([4, 3, 2, 1, 0, 9, 0, 1, 2, 4, 3])
    assert decontaminate.running_tiles(doc, item, 3) == [(6, 0, 3)]


def test_long_texts_of_few_words_take_little_memory():
    items = decontaminate.Items([(1, "w " * 400), (2, "a b " * 200), (3, "w " * 50 + "x y z u v")], 5)
    tracemalloc.start()
    hits = items.hits("w " * 100_000 + "a b " * 50_000, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(h["item_id"], h["longest"]) for h in hits] == [(1, 400), (2, 400), (3, 50)]
    assert hits[2]["coverage"] == pytest.approx(50 / 55) and peak < 200 << 20


def found(spark, docs, items, **kw):
    df = spark.createDataFrame(docs, DOCS).withColumn("hits", F.lit("own")).withColumn("item_id", F.lit(1))
    rows = decontaminate.find(df, spark.createDataFrame(items, ITEMS), **kw).collect()
    return {r["doc_id"]: r["hits"] for r in rows}


ITEM = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu, nu xi omicron pi rho sigma"


def test_reordered_passages_and_spans(spark):
    a, b, c = ITEM.split(". ")[0], "eta THETA iota kappa lambda", "nu xi omicron pi rho sigma"
    text = f"é {c}! between {a}... then\n{b} end"
    hits = found(spark, [(1, text), (2, "nothing of the kind in here at all"), (3, a)], [(7, ITEM), (8, "other words only here now")])
    assert [h["item_id"] for h in hits[1]] == [7] and hits[2] == [] and hits[3] == []
    assert hits[1][0]["coverage"] == pytest.approx(17 / 18)
    assert [text[s["start"]:s["end"]] for s in hits[1][0]["spans"]] == [c, a, b]


def test_blocks_give_the_same_hits(spark):
    items = [(i, f"{ITEM} number{i}") for i in range(6)]
    docs = [(i, f"x {ITEM} number{i} y") for i in range(6)] + [(9, None)]
    one = found(spark, docs, items)
    many = found(spark, docs, items, block_bytes=300)
    key = lambda hits: {d: sorted((h["item_id"], h["coverage"]) for h in hs) for d, hs in hits.items()}
    assert key(one) == key(many) and len(one[0]) == 6


def test_nulls_short_items_long_and_repeated_texts(spark):
    items = [(1, None), (2, ""), (3, "a b"), (None, ITEM), (4, ITEM), (4, ITEM), (5, "w w w w w w w")]
    docs = [(1, None), (2, ""), (3, "a b a b"), (4, ITEM), (5, "v " * 100_000 + ITEM), (6, "w " * 2_000)]
    hits = found(spark, docs, items)
    assert hits[1] == hits[2] == hits[3] == []
    assert sorted(str(h["item_id"]) for h in hits[4]) == sorted(str(h["item_id"]) for h in hits[5]) == ["4", "4", "None"]
    assert [(h["item_id"], h["coverage"]) for h in hits[6]] == [(5, 1.0)]


def test_lower_case_that_changes_length(spark):
    text = "İ " + ITEM.upper()
    hit = found(spark, [(1, text)], [(1, ITEM)])[1][0]
    assert text[hit["spans"][0]["start"]:hit["spans"][0]["end"]] == ITEM.upper()


def test_empty_tables(spark):
    assert found(spark, [], [(1, ITEM)]) == {}
    assert found(spark, [(1, ITEM)], []) == {1: []}


def test_query_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    whole = {(d["doc_id"], i["item_id"]) for d in docs for i in items
             if d["text"] and " ".join(decontaminate.words_of(i["text"])) in " ".join(decontaminate.words_of(d["text"]))}
    got = {(r["doc_id"], r["item_id"]): r for r in queries.op7_decontamination(spark, sf).collect()}
    assert whole <= set(got)
    for d, i in got:
        text = next(x["text"] for x in docs if x["doc_id"] == d)
        item = next(x["text"] for x in items if x["item_id"] == i)
        w, v = decontaminate.words_of(text), decontaminate.words_of(item)
        if len(w) < 300:
            assert got[d, i]["coverage"] == pytest.approx(plain_coverage(w, v, 5))
        assert got[d, i]["coverage"] >= 0.5
