"""Relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_table(spark: SparkSession, url: str, table: str, key: str = "id",
               bounds: tuple[int, int] | None = None, partitions: int = 1,
               **properties: str) -> DataFrame:
    """A table over JDBC, read in parallel key ranges where bounds are given."""
    if bounds is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1],
                           numPartitions=partitions, properties=properties)


def posts_table(spark: SparkSession, path: str) -> DataFrame:
    """Posts as the file-backed table sink keeps them."""
    return spark.read.parquet(path)
