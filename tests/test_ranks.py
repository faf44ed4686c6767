"""Dense numbers within keys: brute force, skew, ties and nulls."""

import random

from pyspark.sql import functions as F

from feedloom.operators import messages, ranks

KIND = "conv_id bigint, turn bigint, text string"


def plain(data):
    """Each row's number within its conversation, unknown turns and texts first."""
    def order(row):
        return (row[1] is not None, row[1] or 0, row[2] is not None, row[2] or "")
    return sorted(((c, t, x, n) for key in {r[0] for r in data} for n, (c, t, x) in enumerate(
        sorted((r for r in data if r[0] == key), key=order))), key=repr)


def test_ranks_equal_a_plain_numbering(spark, rows):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 1, 2, None]), rng.choice([None, 3, rng.randint(-5, 400)]),
             rng.choice(["x", None, str(rng.randint(0, 30))])) for _ in range(3000)]
    df = spark.createDataFrame(data, KIND).repartition(7)
    assert rows(ranks.ranked(df, ["conv_id"], ["turn", "text"])) == plain(data)


def test_rows_equal_in_all_are_spread_and_numbered(spark):
    df = spark.range(20_000).selectExpr("1L conv_id", "5L turn", "'same' text")
    got = ranks.ranked(df, ["conv_id"], ["turn"]).agg(
        F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(got) == (20_000, 0, 19_999)


def test_no_rows_and_clashing_names(spark, rows):
    df = spark.createDataFrame([], "part bigint, row bigint, tie bigint")
    assert ranks.ranked(df, ["part"], ["row"]).columns == ["part", "row", "tie", "rank"]
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 4)], "part bigint, row bigint, tie bigint")
    assert rows(ranks.ranked(df, ["part"], ["row"])) == [(1, 1, 4, 0), (1, 2, 3, 1)]


def test_no_page_is_longer_than_asked(spark):
    data = ([(1, None, f"n{i}") for i in range(500)] + [(1, 7, f"t{i}") for i in range(300)]
            + [(1, 10 ** 12, "far"), (2, -4, None)])
    got = messages.message_history(spark.createDataFrame(data, KIND), 10).collect()
    assert max(r.messages for r in got) == 10 and len(got) == 82
    listed = [x for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.page) for x in r.history]
    assert listed == [
        x for _, _, x, _ in sorted((p for p in plain(data) if p[0] == 1), key=lambda p: p[3])]
    assert {r.total for r in got if r.conv_id == 1} == {801}
    assert [r.history for r in got if r.conv_id == 2] == [[None]]
