"""Bike-share plans over the status and information topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import stations, tables
from feedloom.sinks.writers import BatchWriter
from feedloom.streaming import folds


def publish_status(feed: DataFrame) -> DataFrame:
    """Status snapshots as keyed topic rows."""
    rows = stations.flatten_feed(feed).select(*schemas.STATION_STATUS.names)
    return stations.to_topic(rows, schemas.STATUS_RENAMES)


def publish_info(feed: DataFrame) -> DataFrame:
    """Information snapshots as keyed topic rows."""
    rows = stations.flatten_feed(feed).select(*schemas.STATION_INFO.names)
    return stations.to_topic(rows, schemas.INFO_RENAMES)


def info_table(info_topic: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """The information topic as a table: latest record per station, deletions removed."""
    return tables.latest_per_key(
        stations.decode_info(info_topic, on_error), ["station_id"], "seq",
        ["name", "latitude", "longitude", "capacity"], F.col("deleted"))


def low_availability(status_topic: DataFrame, info_topic: DataFrame,
                     threshold: float = stations.LOW_RATIO) -> DataFrame:
    """Alert messages for stations running out of bikes."""
    alerts = stations.low_availability(
        stations.decode_status(status_topic), info_table(info_topic), threshold)
    return stations.low_availability_lines(alerts)


def set_aside(status_topic: DataFrame, info_topic: DataFrame) -> DataFrame:
    """The malformed records that the plans of this module leave out, by topic."""
    status = stations.malformed_status(status_topic).withColumn("topic", F.lit("status"))
    return status.unionByName(stations.malformed_info(info_topic).withColumn("topic", F.lit("info")))


def turnover(status_topic: DataFrame, info_topic: DataFrame,
             window: str = "60 minutes") -> DataFrame:
    """Turnover per station and window."""
    net = stations.net_delta(stations.decode_status(status_topic), window)
    return stations.turnover_ratio(net, info_table(info_topic))


def turnover_updates(path: str, read_info: Callable[[], DataFrame], write: BatchWriter,
                     window: str = "60 minutes", lateness: str = folds.LATENESS,
                     late: BatchWriter | None = None) -> BatchWriter:
    """For a stream of readings: turnover messages, one for every update of a window's total.

    ``path`` holds the fold's state; ``read_info`` reads the stored information table;
    readings of closed windows go to ``late``, or to files beside the state.
    """
    def messages(changes: DataFrame, batch_id: int) -> None:
        write(stations.turnover_lines(stations.turnover_ratio(changes, read_info())), batch_id)

    return folds.net_delta_writer(path, messages, window, lateness=lateness, late=late)
