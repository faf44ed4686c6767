"""Helpers of streaming queries: event time, lookups per micro-batch, closing a bounded stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators import stations
from feedloom.streaming.folds import LATENESS


def with_event_time(df: DataFrame, column: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Event time with an explicit bound on lateness; later rows are dropped."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def refreshed_lookup(read_info: Callable[[], DataFrame],
                     write: Callable[[DataFrame, int], None],
                     operator=stations.low_availability) -> Callable[[DataFrame, int], None]:
    """A batch writer that looks readings up in information read anew for each batch.

    ``read_info`` reads a stored table (see :func:`feedloom.sinks.writers.entries`),
    not the topic that it was folded from.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        write(operator(batch, read_info()), batch_id)
    return run


def until_closed(start: Callable[[DataFrame], None], stream: DataFrame, closing: DataFrame,
                 close: Callable[[], None]) -> None:
    """Run a bounded stream to its very end.

    A window appends once the watermark has passed its end, which the last rows
    of a bounded stream never reach.  ``start`` runs the query to the end of its
    input; then ``close`` puts one row far ahead in time into the source of
    ``closing``, and a second run from the same checkpoint closes what is open.
    That row's key is one that belongs to no result (an empty ticker, say); it must
    not be null, as rows with null keys are filtered away before the watermark sees them.
    """
    both = stream.unionByName(closing)
    start(both)
    close()
    start(both)
