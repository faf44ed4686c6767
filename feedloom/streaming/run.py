"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedloom.sinks.writers import kafka_options

#: Fixed cadences: feed polling, collector flush, object rotation.
POLL, FLUSH, ROTATE = "30 seconds", "3 seconds", "60 seconds"


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          mode: str = "append", every: str | None = None, name: str | None = None
          ) -> StreamingQuery:
    """Run a batch writer on every micro-batch.

    Without ``every`` the query takes all that is available and stops.  A query
    resumes from its checkpoint; a reset is a new checkpoint directory.
    """
    query = (df.writeStream.foreachBatch(write).outputMode(mode)
             .option("checkpointLocation", checkpoint))
    if name:
        query = query.queryName(name)
    if every:
        return query.trigger(processingTime=every).start()
    return query.trigger(availableNow=True).start()


def run_available(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> StreamingQuery:
    query = start(df, write, checkpoint, mode)
    query.awaitTermination()
    return query


def to_time_partitioned_json(df: DataFrame, path: str, checkpoint: str,
                             rotate: int = 10_000, every: str = ROTATE) -> StreamingQuery:
    """Log records to time-partitioned JSON objects through the exactly-once file sink."""
    from feedloom.operators import logs
    return (logs.with_time_path(df).writeStream.format("json").partitionBy(*logs.PATH)
            .option("path", path).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", rotate).trigger(processingTime=every).start())


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
             compression: str | None = None, mode: str = "append",
             every: str = FLUSH) -> StreamingQuery:
    return (df.writeStream.format("kafka").options(**kafka_options(servers, topic, compression))
            .option("checkpointLocation", checkpoint).outputMode(mode)
            .trigger(processingTime=every).start())


def to_console(df: DataFrame, checkpoint: str, mode: str = "append", every: str = FLUSH,
               out: Callable[[str], None] = print) -> StreamingQuery:
    """Every row of the stream on the console, whole."""
    from feedloom.sinks.writers import console
    return start(df, console(out), checkpoint, mode, every)


def start_each(df: DataFrame, writers: dict[str, Callable[[DataFrame, int], None]], checkpoint: str,
               every: str | None = None) -> dict[str, StreamingQuery]:
    """One query and checkpoint per sink: a sink that fails stops no other."""
    return {name: start(df, write, f"{checkpoint.rstrip('/')}/{name}", every=every)
            for name, write in writers.items()}
