"""Dense numbers within keys of which one may hold a large share of all rows.

Rows are dealt by ranges of (key, order), so a large key is spread over as many
tasks as its share asks for; within a task they are numbered by a window, and
what the earlier tasks hold of the same key is added from a small table of
sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom import session


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with each row's number within its key, from 0, in the given order (nulls first).

    Rows equal in keys and order are numbered in any order; they too are spread, by a
    number of their own.  A null key is a key.  The dealt rows are stored below
    ``spark.checkpoint.dir``, so that the sizes and the numbers come from the same
    ranges, also after a lost executor.
    """
    columns = df.columns
    numbered = df.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("tie"))
    dealt = numbered.repartitionByRange(*[F.col(f"row.{c}") for c in (*keys, *order)], "tie")
    path = session.shared_dir(df.sparkSession, "ranked")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    of = [F.col(f"row.{c}").alias(f"k{i}") for i, c in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    rows = stored.select("row", "tie", "part", *of)
    earlier = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part", *names).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", *names, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")).select(
        *[F.col(c).alias(f"o_{c}") for c in ("part", *names)], "offset").where("offset > 0")
    within = Window.partitionBy("part", *names).orderBy(*[F.col(f"row.{c}") for c in order], "tie")
    here = rows.withColumn("nth", F.row_number().over(within) - 1)
    match = F.col("part") == F.col("o_part")
    for c in names:
        match = match & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    return here.join(offsets, match, "left").select(
        *[F.col(f"row.{c}").alias(c) for c in columns],
        (F.col("nth") + F.coalesce("offset", F.lit(0))).cast("bigint").alias(name))
