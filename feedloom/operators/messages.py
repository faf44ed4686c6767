"""Word streams and message histories.

Messages are (conv_id, turn, text); ``turn`` is the arrival number within the
conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators import ranks

#: Fixed value: the reply to a stream of messages.
ACKNOWLEDGEMENT = "Copy!"


def word_stream(messages: DataFrame, text: str = "text") -> DataFrame:
    """One row per word; words part at single spaces, so empty words are kept."""
    kept = [c for c in messages.columns if c != text]
    return messages.select(*kept, F.posexplode(F.split(text, " ")).alias("position", "word"))


def message_history(messages: DataFrame, page: int) -> DataFrame:
    """The messages of each conversation in arrival order, in pages of ``page`` messages.

    Order is by turn (unknown ones first), then text; a message's place is its rank
    (:func:`feedloom.operators.ranks.ranked`), so no list is longer than ``page``, however
    the turn numbers lie, and a conversation of many messages is ranked by many tasks.
    ``total`` counts the messages of all pages.
    """
    place = ranks.ranked(messages.select("conv_id", "turn", "text"), ["conv_id"], ["turn", "text"], "_rank")
    pages = (place.groupBy("conv_id", F.expr(f"_rank div {page}").alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct("_rank", "text"))).alias("_m"))
             .select("conv_id", "page", F.size("_m").cast("bigint").alias("messages"),
                     F.col("_m.text").alias("history")))
    return pages.withColumn("total", F.sum("messages").over(Window.partitionBy("conv_id")))


def acknowledgements(messages: DataFrame, reply: str = ACKNOWLEDGEMENT) -> DataFrame:
    """One reply per stream, once all of its messages are in."""
    return (messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("messages"))
            .withColumn("reply", F.lit(reply)))


def reply_words(messages: DataFrame, reply: str) -> DataFrame:
    """Fold each stream's messages, then answer with the words of the reply."""
    return word_stream(acknowledgements(messages, reply), "reply")
