"""Ordered work over keys of which one may hold a large share of all rows.

``lag``, running sums and fills need the rows of a key in order, and a plain
window puts a whole key into one task.  The ordered operators take a table of
*hot* keys for that case: rows of these keys are cut into slices, the window
runs per slice, and what has to cross a slice border is carried over by a
second, small step on one summary row per slice.  Without such a table an
operator is one window over one shuffle; the result is the same either way.

``hot_keys`` makes the table from the rows themselves, from a sample of them or
from an earlier run.  It holds at most ``max_hot`` keys with ``slices`` borders
each, so it may be broadcast.  Borders are quantiles of the key's own order
column: a slice holds about an equal share of the key's rows, however its
arrival numbers lie.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT, SLICE, BORDERS = "_hot", "_slice", "_borders"


def hot_keys(df: DataFrame, keys: Sequence[str], order: str, hot_rows: int = 4_000_000,
             slices: int = 128, max_hot: int = 1000) -> DataFrame:
    """(keys, borders) of the largest keys above ``hot_rows`` rows.

    The borders are fixed here, by one pass whose result is bounded: every
    later reading of the table sees the same ones.
    """
    known = df.where(F.col(order).isNotNull()).dropna(subset=list(keys))
    largest = (known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
               .where(F.col("_rows") > hot_rows)
               .orderBy(F.col("_rows").desc(), *keys).limit(max_hot).select(*keys))
    cuts = [i / slices for i in range(1, slices)] or [1.0]
    borders = (known.join(F.broadcast(largest), list(keys), "left_semi").groupBy(*keys)
               .agg(F.percentile_approx(order, cuts, 20 * slices).alias(BORDERS)))
    return df.sparkSession.createDataFrame(borders.collect(), borders.schema)


def with_slices(df: DataFrame, keys: Sequence[str], order: str, hot: DataFrame) -> DataFrame:
    """Add ``_hot`` and ``_slice``; slices follow ``order`` within each hot key.

    Keys must not be null: the operators leave such rows out first.
    """
    marked = df.join(F.broadcast(hot.select(*keys, BORDERS)), list(keys), "left")
    passed = F.size(F.filter(BORDERS, lambda x: x < F.col(order)))
    return (marked.withColumn(HOT, F.col(BORDERS).isNotNull())
            .withColumn(SLICE, F.when(F.col(HOT), passed).otherwise(F.lit(0))).drop(BORDERS))


def slice_window(keys: Sequence[str], order: str):
    """The window of one slice, in order."""
    return Window.partitionBy(*keys, SLICE).orderBy(order)


def with_carry(rows: DataFrame, keys: Sequence[str], summary: DataFrame,
               carried: dict[str, Callable[[object, object], Column]]) -> DataFrame:
    """Join to each row what the earlier slices of its key carry in.

    ``summary`` holds one row per hot (keys, slice).  Each entry of ``carried``
    builds a column from two windows over the summary rows: the ordered window
    (for ``lag``) and the frame of all earlier slices.  Rows of cold keys get
    nulls.
    """
    ordered = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # Attribute names of both sides come from one source: rename before joining.
    carry = summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.col(SLICE).alias("_c_slice"),
        *[build(ordered, earlier).alias(name) for name, build in carried.items()])
    match = F.col(SLICE) == F.col("_c_slice")
    for key in keys:
        match = match & (F.col(key) == F.col(f"_c_{key}"))
    return rows.join(carry, match, "left").drop("_c_slice", *[f"_c_{k}" for k in keys])
