"""Topic sources with one row contract: (key, value, timestamp, partition, offset).

Records of one key share a partition, where offsets give their order.  Without
keys, order is that of :func:`arrival_order`, as one number: :func:`arrival_number`.

``kafka`` needs the connector package of the cluster.  ``topic_files`` reads
the same rows from a directory, which also serves replays and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.sources.files import reader


#: Rows of a micro-batch, so that the first one of a long topic stays bounded.
MAX_OFFSETS = 10_000_000


def kafka_options(servers: str, topic: str, earliest: bool = True,
                  max_offsets: int = MAX_OFFSETS) -> dict[str, str]:
    """Start at the earliest offset; a checkpoint then takes the place of group offsets."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "earliest" if earliest else "latest",
            "maxOffsetsPerTrigger": str(max_offsets)}


def kafka(spark: SparkSession, servers: str, topic: str, stream: bool = True, **kwargs) -> DataFrame:
    """Topic rows."""
    options = kafka_options(servers, topic, **kwargs)
    if not stream:
        del options["maxOffsetsPerTrigger"]
    source = spark.readStream if stream else spark.read
    return text_rows(source.format("kafka").options(**options).load())


def arrival_order(timestamp: str = "timestamp", partition: str = "partition", offset: str = "offset") -> Column:
    """What orders un-keyed records: time, then partition, then offset.

    Unique over the topic.  A struct is an order column as good as a number.
    """
    return F.struct(F.col(timestamp).alias("at"), F.col(partition).alias("partition"), F.col(offset).alias("offset"))


#: Decimal digits of the parts of an arrival number: time in microseconds, partition, offset.
TIME_DIGITS, PARTITION_DIGITS, OFFSET_DIGITS = 16, 5, 17


def arrival_number(timestamp: str = "timestamp", partition: str = "partition", offset: str = "offset") -> Column:
    """:func:`arrival_order` as one decimal(38,0), which windows, folds, slices of hot
    keys (quantiles included) and stored states take like any other number.

    Unique over the topic; a missing partition counts as 0.  A part that has more
    digits than its share (times from the year 2286 on, 100,000 partitions) fails the
    query instead of changing the order.
    """
    micros, part = F.unix_micros(timestamp), F.coalesce(F.col(partition), F.lit(0))
    fits = ((F.abs(micros) < 10 ** TIME_DIGITS) & (part >= 0) & (part < 10 ** PARTITION_DIGITS)
            & (F.col(offset) >= 0) & (F.col(offset) < 10 ** OFFSET_DIGITS))
    # Times before 1970 are negative; what follows them still counts upwards.
    place = part.cast("decimal(5,0)") * F.lit(10 ** OFFSET_DIGITS).cast("decimal(18,0)") + F.col(offset).cast("decimal(17,0)")
    number = (micros.cast("decimal(16,0)") * F.expr(f"cast('1e{PARTITION_DIGITS + OFFSET_DIGITS}' as decimal(23,0))")
              + place).cast("decimal(38,0)")
    known = F.col(timestamp).isNotNull() & F.col(offset).isNotNull()
    return F.when(known & fits, number).when(known, F.raise_error(F.lit("a record's place has too many digits"))
                                             .cast("decimal(38,0)"))


def text_rows(raw: DataFrame) -> DataFrame:
    """Byte keys and values as UTF-8 text; a partition is kept where there is one."""
    place = ["partition"] if "partition" in raw.columns else []
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), "timestamp", *place, "offset")


def topic_files(spark: SparkSession, path: str, stream: bool = False,
                max_files: int | None = None) -> DataFrame:
    return reader(spark, stream, max_files).schema(schemas.TOPIC_ROW).parquet(path)
