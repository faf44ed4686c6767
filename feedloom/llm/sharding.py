"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered 0 to N-1 by a hash of their key, which depends on the rows
alone and not on files, partitions or settings.  A keyed permutation of
[0, N) then gives each row its place; ``place mod shards`` is the shard and
``place div shards`` the slot.  Shard sizes differ by one row at most, slots
have no gaps, and anyone who knows (row number, N, shards, seed) can compute
both, or go back from a place to the row number.

The permutation is a Feistel network on an ``a`` x ``b`` grid, the smallest
near-square one with ``a * b >= N``: left and right half add a keyed hash of
each other in turn, modulo ``a`` and ``b``.  A value that lands in the grid
outside [0, N) is permuted again until it falls inside (cycle walking).

Defined cases: a null text counts 0 bytes and has the checksum of the empty
text; null ids are keys like any other; rows equal in id and text are
interchangeable and get different places; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
#: Buckets of the numbering; their offsets are the only table that every task reads.
BUCKET_BITS = 12
#: Steps of the cycle walk that a plan carries.  At most a - 1 of the grid's
#: places lie outside [0, N), so a walk needs at most a steps; with a > WALK a
#: longer one has a chance below a ** -WALK, and is reported, not passed over.
WALK = 64


def permute(x: Column, a: Column, b: Column, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the Feistel network over [0, a * b)."""
    def turn(half: Column, other: Column, k: Column, size: Column) -> Column:
        return (half + F.pmod(F.xxhash64(other, k, F.lit(seed)), size)) % size

    def step(s: Column, k: Column) -> Column:
        left, right = s["l"], s["r"]
        return F.when(k % 2 == 0, F.struct(turn(left, right, k, a).alias("l"), right.alias("r"))
                      ).otherwise(F.struct(left.alias("l"), turn(right, left, k, b).alias("r")))

    halves = F.struct(((x - x % b) / b).cast("bigint").alias("l"), (x % b).alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), halves, step,
                       lambda s: s["l"] * b + s["r"])


def invert(y: Column, a: Column, b: Column, seed: int, rounds: int = ROUNDS) -> Column:
    """The inverse of ``permute``."""
    def back(half: Column, other: Column, k: Column, size: Column) -> Column:
        return F.pmod(half - F.pmod(F.xxhash64(other, k, F.lit(seed)), size), size)

    def step(s: Column, k: Column) -> Column:
        left, right = s["l"], s["r"]
        return F.when(k % 2 == 0, F.struct(back(left, right, k, a).alias("l"), right.alias("r"))
                      ).otherwise(F.struct(left.alias("l"), back(right, left, k, b).alias("r")))

    halves = F.struct(((y - y % b) / b).cast("bigint").alias("l"), (y % b).alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in reversed(range(rounds))]), halves, step,
                       lambda s: s["l"] * b + s["r"])


def _walk(x: Column, total: Column, pass_: object) -> Column:
    a = F.ceil(F.sqrt(total.cast("double"))).cast("bigint")
    b = F.ceil(total / a).cast("bigint")
    y = F.aggregate(F.array(*[F.lit(k) for k in range(WALK)]), pass_(x, a, b),
                    lambda y, _: F.when(y >= total, pass_(y, a, b)).otherwise(y))
    return F.when(y < total, y).otherwise(F.raise_error(F.lit("cycle walk did not end")))


def place(number: Column, total: Column, seed: int) -> Column:
    """The place of row ``number`` in the shuffle of ``total`` rows."""
    return _walk(number, total, lambda x, a, b: permute(x, a, b, seed))


def row_at(position: Column, total: Column, seed: int) -> Column:
    """The row number that the shuffle puts at ``position``."""
    return _walk(position, total, lambda x, a, b: invert(x, a, b, seed))


def numbered(rows: DataFrame, key_hash: str, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """Add ``row_number`` (0 to N-1, in the order of the hash) and ``total``.

    Equal rows are counted before the shuffle, so that a row repeated very often
    crosses it once per task.  Buckets are the hash's upper bits; their counts
    (2 ** bucket_bits rows at most) give each bucket its first number.
    """
    columns = rows.columns
    bucket = F.shiftrightunsigned(F.col(key_hash), 64 - bucket_bits)
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_bucket", bucket)
    in_order = Window.orderBy("_bucket")
    starts = (groups.groupBy("_bucket").agg(F.sum("_copies").alias("_rows"))
              .select(F.col("_bucket"),
                      (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_start"),
                      F.sum("_rows").over(in_order.rowsBetween(Window.unboundedPreceding,
                                                               Window.unboundedFollowing)).alias("total")))
    within = Window.partitionBy("_bucket").orderBy(key_hash, *[c for c in columns if c != key_hash])
    placed = groups.withColumn("_first", F.sum("_copies").over(within) - F.col("_copies"))
    return (placed.join(F.broadcast(starts), "_bucket")
            .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
            .select(*columns, (F.col("_start") + F.col("_first") + F.col("_copy")).alias("row_number"),
                    "total"))


def shards(docs: DataFrame, n_shards: int, seed: int = 0, *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Each row's id, size, checksum, global row number, shard and slot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("_hash"))
    at = place(F.col("row_number"), F.col("total"), seed)
    return (numbered(slim, "_hash")
            .withColumn("_place", at)
            .select("doc_id", "size", "text_crc32", "row_number", "total",
                    F.pmod("_place", F.lit(n_shards)).cast("int").alias("shard"),
                    ((F.col("_place") - F.col("_place") % n_shards) / n_shards).cast("bigint").alias("slot")))
