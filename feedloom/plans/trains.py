"""Train tracking: from trip update messages to countdown messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from feedloom.operators import transit
from feedloom.sinks.writers import BatchWriter
from feedloom.sources import topics
from feedloom.streaming import folds


def arrivals(topic: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """(seq, route_id, stop_id, direction, arrival) of trip update messages.

    ``seq`` is the record's offset.  The topic has no keys, so where records have a
    partition, ``arrived`` gives their order over all partitions.
    """
    if "partition" in topic.columns:
        topic = topic.withColumn(transit.ARRIVED, topics.arrival_number())
    updates = transit.decode_trip_updates(topic, on_error).withColumnRenamed("offset", "seq")
    return transit.stop_times(updates)


def countdown(topic: DataFrame, stops: DataFrame, now: Column, hot: DataFrame | None = None) -> DataFrame:
    """Countdown messages of every improved arrival; ``hot`` spreads the tracks it names."""
    better = transit.arrival_improvements(arrivals(topic), now, hot)
    return transit.arrival_messages(better, stops, now)


def countdown_updates(path: str, stops: DataFrame, now: Callable[[], Column], write: BatchWriter) -> BatchWriter:
    """For a stream of arrivals: countdown messages as arrivals improve."""
    def messages(better: DataFrame, batch_id: int) -> None:
        write(transit.arrival_messages(better, stops, now()), batch_id)

    return folds.improvements_writer(path, messages, now)
