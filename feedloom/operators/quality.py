"""JSON decoding with a policy for malformed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def once(expression: Column) -> Column:
    """Evaluate a costly expression once per row.

    A filter on a projected column is pushed below the projection, and each of
    its terms then evaluates the expression again.  A generator is a border
    that no filter on its output crosses.  Use it alone in ``withColumn``.
    """
    return F.explode(F.array(expression))


def decode_json(value: Column, schema: T.StructType, on_error: str = "quarantine") -> Column:
    """Parse a JSON value.

    ``fail`` aborts the query at the first malformed record.  ``quarantine``
    keeps the raw text of such a record in the struct field ``_corrupt_record``.
    """
    if on_error == "fail":
        # A missing or empty value parses to null; it is no record either.
        return F.coalesce(F.from_json(value, schema, {"mode": "FAILFAST"}),
                          F.raise_error(F.lit("malformed record: no value")))
    if on_error != "quarantine":
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    kept = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def is_malformed(decoded: Column, value: Column) -> Column:
    """True where decoding failed; a missing value cannot be decoded either."""
    return value.isNull() | decoded.isNull() | decoded[CORRUPT].isNotNull()


def mark_malformed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add the ``decoded`` struct and the flag ``malformed``, parsing each value once."""
    decoded = df.withColumn("decoded", once(decode_json(F.col(value), schema)))
    return (decoded.withColumn("malformed", is_malformed(F.col("decoded"), F.col(value)))
            .withColumn("decoded", F.when(~F.col("malformed"),
                                          F.col("decoded").dropFields(CORRUPT))))


def quarantine_split(df: DataFrame, schema: T.StructType, value: str = "value"
                     ) -> tuple[DataFrame, DataFrame]:
    """(good rows with a ``decoded`` struct, malformed rows as they came)."""
    marked = mark_malformed(df, schema, value)
    return (marked.where(~F.col("malformed")).drop("malformed"),
            marked.where("malformed").drop("malformed", "decoded"))
