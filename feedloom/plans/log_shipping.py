"""One log topic to three independent sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.operators import logs
from feedloom.sinks import writers


def ship(object_path: str, document_path: str, show: bool = False) -> writers.BatchWriter:
    """Objects by time path, search documents and, on demand, the console."""
    targets = [writers.time_partitioned_json(object_path), writers.documents(document_path)]
    if show:
        targets.append(writers.console())
    return writers.fan_out(targets)


def targets(object_path: str, document_path: str) -> dict[str, writers.BatchWriter]:
    """The sinks by name, to be run as queries of their own."""
    return {"objects": writers.time_partitioned_json(object_path),
            "documents": writers.documents(document_path), "console": writers.console()}


def collect(records: DataFrame, routes: list[tuple[str, str]] = logs.DEFAULT_ROUTES) -> DataFrame:
    """Tagged records as un-keyed topic messages."""
    return logs.route_tags(records, routes).selectExpr(
        "cast(null as string) as key", "record as value", "topic")
