"""Multi-party chat rendering, once from the perspective of every participant.

For each conversation and each of its speakers, the dialogue is rendered with
that speaker as the assistant and everybody else as a named user.  The loss
spans cover what the assistant says, its end mark included, as code-point
offsets into the rendered text; everything else is masked.

A dialogue comes as one row, or as several numbered parts where it has more
than ``PART_TURNS`` turns: each part has that many, the last one the rest, so that
no row grows with a conversation, whatever its turn numbers are.  ``offset``
is where the part starts within the whole dialogue.  The output has one copy of
a dialogue per speaker; that is the operation itself.

Defined cases: turns follow (turn, role, text), nulls first; a null role is the
speaker ``unknown``; a null text is empty but keeps its turn; rows without a
conversation id form one conversation; repeated rows are repeated turns; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import written

PART_TURNS = 1024
#: Characters of a text by which turns are dealt to the tasks that order them.
ORDERED_BY = 256
END = "<|end|>\n"
UNKNOWN = "unknown"


def opening(own: Column, name: Column) -> Column:
    """The mark before a turn."""
    return F.when(own, F.lit("<|assistant|>\n")).otherwise(
        F.concat(F.lit("<|user name="), name, F.lit("|>\n")))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rank``, their place in the order of all turns.

    A range partitioning is stored with each row's place in its partition; the
    partitions' sizes, one row each, give the offsets.  Equal short turns are
    told apart by a number, so that any count of them is dealt evenly.
    """
    short = F.char_length("said") <= ORDERED_BY
    numbered = rows.withColumn("_tie", F.when(short, F.monotonically_increasing_id()))
    order = ["conv_id", "turn", "role", F.substring("said", 1, ORDERED_BY), ~short, "_tie"]
    stored = written(numbered.repartitionByRange(*order).sortWithinPartitions(*order, "said").select(
        *rows.columns, F.monotonically_increasing_id().alias("_id")), "turns")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.groupBy(part.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_task", (F.sum("_rows").over(Window.orderBy("_task")) - F.col("_rows")).alias("_before"))
    return (stored.withColumn("_task", part).join(F.broadcast(offsets), "_task")
            .select(*rows.columns, (F.col("_before") + place).alias("_rank")))


def rotate(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, participant, part): text, loss_spans, turn counts and offset.

    A conversation is cut by the rank of its turns, ``part_turns`` to a part.
    """
    rows = _ranked(turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("said")))
    speakers = rows.groupBy("conv_id", "role").agg(F.min("_rank").alias("first"))
    views = speakers.select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("participant"),
        F.min("first").over(Window.partitionBy("conv_id")).alias("_first"))
    own = F.col("role") == F.col("participant")
    spoken = (rows.join(views, F.col("conv_id").eqNullSafe(F.col("_conv")))
              .withColumn("part", F.floor((F.col("_rank") - F.col("_first")) / part_turns).cast("int"))
              .withColumn("_open", opening(own, F.col("role")))
              .withColumn("_own", own)
              .withColumn("_segment", F.concat("_open", "said", F.lit(END))))
    page = Window.partitionBy("conv_id", "participant", "part").orderBy("_rank")
    placed = spoken.withColumn(
        "_at", F.sum(F.char_length("_segment")).over(page) - F.char_length("_segment")).withColumn(
        "_nth", F.row_number().over(page))
    span = F.when(F.col("_own"), F.struct(
        (F.col("_at") + F.char_length("_open")).alias("start"),
        (F.col("_at") + F.char_length("_segment") - 1).alias("end")))
    pieces = F.sort_array(F.collect_list(F.struct("_nth", "_segment")))
    parts = placed.groupBy("conv_id", "participant", "part").agg(
        F.array_join(F.transform(pieces, lambda x: x["_segment"]), "").alias("text"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("_own")).alias("n_own_turns"),
        F.sum(F.char_length("_segment")).alias("n_chars"))
    dialogue = Window.partitionBy("conv_id", "participant").orderBy("part")
    return parts.withColumn("offset", F.sum("n_chars").over(dialogue) - F.col("n_chars"))
