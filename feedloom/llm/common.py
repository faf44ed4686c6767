"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables; other columns are never looked at."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def filled(column: str) -> Column:
    """A text column whose nulls count as empty texts."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: every reader sees
    the same rows, and no executor's loss can change or undo them."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(base: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per application.

    The archive is code, made where the driver runs; Spark copies it to each executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task: one object, made anew for another key.

    ``key`` begins with the module that the object serves.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release_others(module: str) -> None:
    """Drop what the worker keeps for other modules."""
    if any(key[0] != module for key in _held):
        _held.clear()
        give_back()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package at hand in every worker.

    A Python worker serves many tasks and stages: what a task has held goes back
    to the system when it ends, what it keeps when another module's task begins.
    """
    module = run.__module__

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(module)
        yield from run(batches)
        give_back()

    ship_code(df.sparkSession)
    return df.mapInArrow(tidy, schema)


def slices(batch: pa.RecordBatch, texts: str | None = None, rows: int = 512,
           size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Short pieces of a batch, of at most ``size`` bytes in the column ``texts``
    (or one row), so that a task never holds the work of many long texts at once."""
    n, at = batch.num_rows, 0
    total = np.arange(n) * 0 if texts is None else np.cumsum(
        pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < n:
        before = int(total[at - 1]) if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(total, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end


def decoded_texts(column: pa.Array) -> list[str]:
    """The texts of a binary column: nulls are empty, what is not UTF-8 is replaced."""
    return ["" if x is None else x.decode("utf-8", "replace") for x in column.to_pylist()]


def with_columns(batch: pa.RecordBatch, without: list[str], made: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch without some of its columns and with the new ones at its end."""
    kept = [n for n in batch.schema.names if n not in without]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *made.values()], [*kept, *made])


def give_back() -> None:
    """Return freed memory to the system, as far as the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
