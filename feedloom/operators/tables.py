"""Topics read as tables: latest value per key, and the value as of an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators import skew


def latest_versions(df: DataFrame, keys: Sequence[str], order: str | Column,
                    values: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """Last write per key, with a ``deleted`` flag where deletions are given.

    ``order`` must be unique per key (a topic offset).  One ``max_by`` per
    column, with fixed-width columns, keeps the hash aggregate and its map-side
    combine: a hot key leaves every map task as a single row.  On a stream this
    is the upsert table's changelog in ``update`` mode.
    """
    order = F.col(order) if isinstance(order, str) else order
    aggs = [F.max_by(v, order).alias(v) for v in values]
    if deleted is not None:
        aggs.append(F.max_by(deleted, order).alias("deleted"))
    return df.groupBy(*keys).agg(*aggs)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Column,
                   values: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """Last write per key; keys whose last write is a deletion are left out."""
    latest = latest_versions(df, keys, order, values, deleted)
    return latest if deleted is None else latest.where(~F.col("deleted")).drop("deleted")


def upsert_entries(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Key-value entries where the last write wins."""
    return latest_per_key(df.where(F.col(key).isNotNull()), [key], order, [value])


def asof_lookup(facts: DataFrame, versions: DataFrame, key: str, order: str,
                values: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """For each fact, the version of its key that was valid when it arrived.

    A left lookup: facts before the first version, or after a deletion (a
    version whose values are all null), get nulls.  A version with the same
    order value as the fact is already valid.  Facts and versions are merged
    into one ordered sequence per key, so each row is read and shuffled once and
    no range join is formed; ``hot`` spreads the keys it names.
    """
    version = F.struct(*[F.col(v) for v in values])
    fact_cols = [c for c in facts.columns if c not in (key, order)]
    sequence = facts.where(F.col(key).isNotNull()).select(
        key, order, F.struct(F.lit(True).alias("_is_fact"), *fact_cols).alias("_fact")
    ).unionByName(
        versions.where(F.col(key).isNotNull()).select(key, order, version.alias("_version")),
        allowMissingColumns=True)
    rows = sequence if hot is None else skew.with_slices(sequence, [key], order, hot)
    slice_keys = [key] if hot is None else [key, skew.SLICE]
    upto = (Window.partitionBy(*slice_keys).orderBy(order)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (rows.withColumn("_found", F.last("_version", ignorenulls=True).over(upto))
              .where(F.col("_fact").isNotNull()))
    found = F.col("_found")
    if hot is not None:
        seen = F.when(F.col("_version").isNotNull(), F.col(order))
        summary = (rows.where(skew.HOT).groupBy(key, skew.SLICE)
                   .agg(F.max_by("_version", seen).alias("_last")))
        filled = skew.with_carry(filled, [key], summary, {
            "_carry": lambda ordered, earlier: F.last("_last", ignorenulls=True).over(earlier)})
        found = F.coalesce("_found", "_carry")
    return filled.select(
        key, order, *[F.col(f"_fact.{c}").alias(c) for c in fact_cols],
        *[found[v].alias(v) for v in values])
