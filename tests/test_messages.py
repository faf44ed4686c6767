from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedloom.operators import messages


def conversation(spark, *data):
    return spark.createDataFrame(list(data), "conv_id bigint, turn bigint, text string")


def test_words_keep_empty_ones(spark, rows):
    got = messages.word_stream(conversation(spark, (1, 0, "a  b ")))
    assert rows(got, "position", "word") == [(0, "a"), (1, ""), (2, "b"), (3, "")]


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab |.*\\", max_size=12), min_size=1, max_size=5))
def test_words_are_a_single_space_split(spark, texts):
    df = conversation(spark, *[(1, i, t) for i, t in enumerate(texts)])
    got = sorted((r.turn, r.position, r.word) for r in messages.word_stream(df).collect())
    assert got == [(i, j, w) for i, t in enumerate(texts) for j, w in enumerate(t.split(" "))]


def test_history_in_turn_order_by_page(spark, rows):
    df = conversation(spark, *[(1, i, f"m{i}") for i in (3, 1, 0, 2, 4)], (2, 0, "x"))
    assert rows(messages.message_history(df, page=2), "conv_id", "page", "total", "history") == [
        (1, 0, 5, ["m0", "m1"]), (1, 1, 5, ["m2", "m3"]), (1, 2, 5, ["m4"]), (2, 0, 1, ["x"])]


def test_one_acknowledgement_per_stream_then_words(spark, rows):
    df = conversation(spark, (1, 0, "a"), (1, 1, "b"), (2, 0, "c"))
    assert rows(messages.acknowledgements(df)) == [(1, 2, "Copy!"), (2, 1, "Copy!")]
    assert rows(messages.reply_words(df, "Well done"), "conv_id", "messages", "word") == [
        (1, 2, "Well"), (1, 2, "done"), (2, 1, "Well"), (2, 1, "done")]
