import random

import pytest

from feedloom.operators import tables
from feedloom.operators.skew import hot_keys, with_slices


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, None), ("a", 2, 30), ("b", 5, 50)],
                               "k string, seq bigint, v int")
    assert rows(tables.latest_per_key(df, ["k"], "seq", ["v"])) == [("a", None), ("b", 50)]
    gone = tables.latest_per_key(df, ["k"], "seq", ["v"], df["v"].isNull())
    assert rows(gone) == [("b", 50)]


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_asof_equals_brute_force(spark, rows, slices):
    rng = random.Random(3)
    facts, versions, current, want = [], [], {}, []
    for seq in range(400):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        if rng.random() < 0.1:
            value = rng.choice([None, 1, 2, 3])
            versions.append((key, seq, value))
            current[key] = value
        if rng.random() < 0.8:
            facts.append((key, seq, seq * 2))
            want.append((key, seq, seq * 2, current.get(key)))
    f = spark.createDataFrame(facts, "k string, seq bigint, x int")
    hot = hot_keys(f, ["k"], "seq", hot_rows=5, slices=slices) if slices else None
    got = tables.asof_lookup(
        f, spark.createDataFrame(versions, "k string, seq bigint, v int"), "k", "seq", ["v"], hot)
    assert got.columns == ["k", "seq", "x", "v"]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("step", [1, 1_000_003])
def test_slices_share_the_rows_of_a_hot_key(spark, step):
    """However far apart its arrival numbers lie."""
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) k", f"id * {step} seq")
    hot = hot_keys(df, ["k"], "seq", hot_rows=50, slices=8)
    assert [r["k"] for r in hot.collect()] == ["hot"]
    sliced = with_slices(df, ["k"], "seq", hot)
    sizes = [r["count"] for r in sliced.where("_hot").groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 334 / 8 * 1.3
    assert sliced.where("not _hot and _slice <> 0").count() == 0


def test_only_the_largest_keys_are_listed(spark):
    df = spark.range(60).selectExpr("case when id < 30 then 'a' when id < 50 then 'b' else 'c' end k",
                                    "id seq")
    assert sorted(r["k"] for r in hot_keys(df, ["k"], "seq", hot_rows=5, slices=3, max_hot=2).collect()) == ["a", "b"]
