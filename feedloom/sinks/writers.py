"""Batch writers for tables, topics, objects, documents, text and the console."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import logs, tables

BatchWriter = Callable[[DataFrame, int], None]
BATCH = "batch_id"


def _target(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={batch_id}"


def files(path: str, fmt: str = "parquet", **options) -> BatchWriter:
    """One directory per batch, replaced when the batch is replayed."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).options(**options).save(_target(path, batch_id))
    return write


def text(path: str) -> BatchWriter:
    """Lines from the ``value`` column."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.select("value").write.mode("overwrite").text(_target(path, batch_id))
    return write


def json_lines(path: str, compression: str = "gzip") -> BatchWriter:
    return files(path, "json", compression=compression)


def time_partitioned_json(path: str, rotate: int = 10_000, **options) -> BatchWriter:
    """JSON objects below year/month/day/hour, at most ``rotate`` records each.

    Records are rebalanced by path first: few objects for a quiet hour, several
    tasks for a busy one.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        (logs.with_time_path(df).hint("rebalance", *logs.PATH)
         .withColumn(BATCH, F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", rotate).options(**options)
         .partitionBy(*logs.PATH, BATCH).json(path))
    return write


def documents(path: str) -> BatchWriter:
    """Search documents as JSON lines; ids make a replay overwrite itself."""
    def write(df: DataFrame, batch_id: int) -> None:
        logs.index_documents(df).write.mode("overwrite").json(_target(path, batch_id))
    return write


def entries(path: str, key: str, value: str, order: str) -> BatchWriter:
    """Key-value entries: each batch keeps its last write per key.

    Batches are small deltas; :func:`read_entries` lets the last batch win, so
    no write ever rewrites the store.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        delta = tables.upsert_entries(df, key, value, order)
        delta.write.mode("overwrite").parquet(_target(path, batch_id))
    return write


def read_entries(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    return tables.latest_per_key(spark.read.parquet(path), [key], BATCH, [value])


def compact_entries(spark: SparkSession, source: str, target: str, key: str, value: str) -> None:
    """Fold the deltas of an entry store into the first batch of a new one."""
    held = read_entries(spark, source, key, value)
    held.write.mode("overwrite").parquet(_target(target, 0))


def jdbc(url: str, table: str, key: str | None = None, **properties: str) -> BatchWriter:
    """Append rows in one job per batch.

    With ``key``, an integer column, rows whose key the table already holds are
    left out, which makes a replayed batch harmless.  Only the batch's own key
    range is read back.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        rows = df
        if key is not None:
            low, high = df.agg(F.min(key), F.max(key)).first()
            if low is None:
                return
            held = df.sparkSession.read.jdbc(
                url, f"(select {key} from {table} where {key} between {int(low)} and {int(high)}) held",
                properties=properties)
            # Of two rows of a batch with one key, the one that sorts first is written.
            rest = [c for c in df.columns if c != key]
            one = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(
                *[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
            rows = (one if rest else df.distinct()).join(held, key, "left_anti")
        rows.write.jdbc(url, table, mode="append", properties=properties)
    return write


def kafka(servers: str, topic: str, compression: str | None = None) -> BatchWriter:
    """Keyed or un-keyed messages, acknowledged by all replicas."""
    def write(df: DataFrame, batch_id: int) -> None:
        columns = [c for c in ("key", "value", "topic") if c in df.columns]
        (df.select(*columns).write.format("kafka")
         .options(**kafka_options(servers, topic, compression)).save())
    return write


def kafka_options(servers: str, topic: str, compression: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    if compression:
        options["kafka.compression.type"] = compression
    return options


def console(out: Callable[[str], None] = print) -> BatchWriter:
    """Every row of a batch as one JSON line, whole.

    Rows come to the driver one partition at a time.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        for line in df.toJSON().toLocalIterator():
            out(line)
    return write


def fan_out(writers: Sequence[BatchWriter]) -> BatchWriter:
    """Send each batch to every writer, reading its source once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for one in writers:
                one(df, batch_id)
        finally:
            df.unpersist()
    return write


def routed(route: str, writers: dict[str, BatchWriter]) -> BatchWriter:
    """Send the rows of each route to that route's writer."""
    def one(name: str, target: BatchWriter) -> BatchWriter:
        return lambda df, batch_id: target(df.where(F.col(route) == name), batch_id)
    return fan_out([one(name, target) for name, target in writers.items()])
