"""Tables whose readers see whole versions only.

Rows are written aside, below ``data``; then one small file below ``versions``
names the parts that make up the table.  That file comes into being by a single
move, so a reader finds either the old list or the new one: a task that fails
half-way, a replay and a compaction show nothing in between.  Parts are never
overwritten; a reader that has begun goes on with the version it found.

One writer at a time; readers do not matter.  Parts that no version of interest
names any more are :func:`retired` and may be removed.

A table without a version is empty.  A batch that comes again takes the place of
its earlier rows.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators import tables
from feedloom.sinks.writers import BATCH, BatchWriter

VERSION = "version"
#: A version's list: each part with the batch whose rows it holds.
PARTS = T.StructType([T.StructField(BATCH, T.LongType()), T.StructField("part", T.StringType())])
#: The batch number of what has been compacted; all others come after it.
COMPACTED = -1


def _folder(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version; the files are listed, not read."""
    try:
        listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
                  .option("basePath", _folder(path, "versions")).load(_folder(path, "versions")))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # A version whose file has not come yet is a folder without a file.
    if VERSION not in listed.columns:
        return None
    return listed.agg(F.max(F.col(VERSION).cast("long"))).first()[0]


def parts(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[int, str]]:
    """(batch, folder) of each part of a version, the newest if none is named.

    One line per batch since the last compaction."""
    version = latest_version(spark, path) if version is None else version
    if version is None:
        return []
    rows = spark.read.schema(PARTS).json(_folder(path, "versions", f"{VERSION}={version}"))
    return sorted((r[BATCH], r["part"]) for r in rows.collect())


def _publish(spark: SparkSession, path: str, version: int, listed: list[tuple[int, str]]) -> None:
    target = _folder(path, "versions", f"{VERSION}={version}")
    # What an attempt that ended before its move has left there is no version.
    spark.createDataFrame(listed, PARTS).coalesce(1).write.mode("overwrite").json(target)


def _stage(df: DataFrame, path: str) -> str:
    """Write rows aside; returns the part's name below ``data``."""
    part = uuid.uuid4().hex
    df.write.parquet(_folder(path, "data", part))
    return part


def publish(df: DataFrame, path: str, batch_id: int) -> int:
    """Add a batch to the table, or put it in the place of its earlier rows; returns the version."""
    spark = df.sparkSession
    version = latest_version(spark, path)
    listed = [] if version is None else parts(spark, path, version)
    part = _stage(df, path)
    kept = [(b, p) for b, p in listed if b != batch_id]
    _publish(spark, path, (version or 0) + 1, [*kept, (batch_id, part)])
    return (version or 0) + 1


def table(path: str) -> BatchWriter:
    """A batch writer whose batches show whole or not at all."""
    def write(df: DataFrame, batch_id: int) -> None:
        publish(df, path, batch_id)
    return write


def read(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named, with the batch they came in."""
    kept = T.StructType([f for f in schema.fields if f.name != BATCH])
    listed = parts(spark, path, version)
    if not listed:
        return spark.createDataFrame([], T.StructType([*kept.fields, T.StructField(BATCH, T.LongType())]))
    rows = spark.read.schema(kept).parquet(*[_folder(path, "data", p) for _, p in listed])
    # A part's batch is known by its folder.
    of = F.create_map(*[F.lit(x) for batch, part in listed for x in (part, batch)])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(*kept.names, of[folder].cast("long").alias(BATCH))


def entries(path: str, key: str, value: str, order: str) -> BatchWriter:
    """Key-value entries: each batch publishes its last write per key."""
    def write(df: DataFrame, batch_id: int) -> None:
        publish(tables.upsert_entries(df, key, value, order), path, batch_id)
    return write


def _entry_schema(key: str, value: str) -> T.StructType:
    return T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.StringType())])


def read_entries(spark: SparkSession, path: str, key: str, value: str, version: int | None = None) -> DataFrame:
    """The last write of each key."""
    rows = read(spark, path, _entry_schema(key, value), version)
    return tables.latest_per_key(rows, [key], BATCH, [value])


def compact_entries(spark: SparkSession, path: str, key: str, value: str) -> int | None:
    """Fold all batches into one part and publish it in their place.

    Batches after the folded ones keep their numbers; a folded batch that came
    again would count as a new one, so fold only what will not be replayed.
    """
    version = latest_version(spark, path)
    if version is None:
        return None
    part = _stage(read_entries(spark, path, key, value, version), path)
    _publish(spark, path, version + 1, [(COMPACTED, part)])
    return version + 1


def retired(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Folders of the parts that none of the ``keep`` newest versions names."""
    newest = latest_version(spark, path)
    if newest is None:
        return []
    named = {p for v in range(max(1, newest - keep + 1), newest + 1) for _, p in parts(spark, path, v)}
    held = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(_folder(path, "data"))
            .select(F.element_at(F.split("path", "/"), -2).alias("part")).distinct())
    return sorted(_folder(path, "data", r["part"]) for r in held.collect() if r["part"] not in named)
