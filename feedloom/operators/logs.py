"""Log records: routing by tag, time-path layout, search documents.

Records are (tag, ts, record) with ``record`` a JSON text, and ``seq`` the
offset where the sink needs one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import tags, times

PATH = ["year", "month", "day", "hour"]
DEFAULT_ROUTES = [("*.**", "log-messages")]


def route_tags(logs: DataFrame, routes: list[tuple[str, str]] = DEFAULT_ROUTES) -> DataFrame:
    """Add the topic of the first matching pattern; unmatched records drop out."""
    return (logs.withColumn("topic", tags.topic_for(F.col("tag"), routes))
            .where(F.col("topic").isNotNull()))


def route_index(spark: SparkSession, routes: list[tuple[str, str]]) -> DataFrame:
    """(side, key, regex, rank, topic): each single pattern under the literal parts it begins
    or ends with, whichever are longer.  Of equal patterns the first route counts."""
    rows: dict[str, tuple] = {}
    for rank, (patterns, topic) in enumerate(routes):
        for pattern in patterns.split():
            begin, end = tags.literal_ends(pattern)
            side, key = ("end", end) if len(end) > len(begin) else ("begin", begin)
            rows.setdefault(pattern, (side, key, tags.tag_regex(pattern), rank, topic))
    return spark.createDataFrame(list(rows.values()), "side string, key string, regex string, rank int, topic string")


def _ends(tag: Column) -> Column:
    """Every (side, key) that a pattern matching the tag may stand under."""
    parts = F.split(tag, "[.]")
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array(
        F.struct(F.lit("begin").alias("side"), F.array_join(F.slice(parts, F.lit(1), n), ".").alias("key")),
        F.struct(F.lit("end").alias("side"),
                 F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".").alias("key")))))


def route_tags_by_index(logs: DataFrame, index: DataFrame) -> DataFrame:
    """Like :func:`route_tags` for any number of routes: the plan does not grow with them.

    Each distinct tag is resolved once: it meets the patterns that begin or end
    with some of its own parts, and of those that match, the first route wins.
    Patterns without a literal end meet every distinct tag.  Records then look
    their tag up by an equi-join.  For batches; a stream does it per micro-batch.
    """
    known = logs.select("tag").where(F.col("tag").isNotNull()).distinct()
    keyed = known.select("tag", F.explode(F.array_distinct(_ends(F.col("tag")))).alias("_e")).select(
        "tag", F.col("_e.side").alias("side"), F.col("_e.key").alias("key"))
    chosen = (keyed.join(index, ["side", "key"]).where(F.rlike("tag", F.col("regex")))
              .groupBy("tag").agg(F.min_by("topic", "rank").alias("topic")))
    kept = [c for c in logs.columns if c != "topic"]
    return logs.select(*kept).join(chosen, "tag").where(F.col("topic").isNotNull()).select(*kept, "topic")


def with_time_path(logs: DataFrame) -> DataFrame:
    """Add year, month, day and hour of the record time, UTC."""
    return logs.select("*", *times.path_parts(F.col("ts")))


def partition_counts(logs: DataFrame, rotate: int = 10_000) -> DataFrame:
    """Records and objects per time path, at ``rotate`` records an object."""
    return (with_time_path(logs).groupBy(*PATH)
            .agg(F.count(F.lit(1)).alias("records"))
            .withColumn("objects", F.ceil(F.col("records") / rotate).cast("bigint")))


def index_documents(logs: DataFrame, topic: str = "log-messages", partition: int = 0) -> DataFrame:
    """Search documents: an id that a replay repeats, and the record as its body.

    The id names topic, partition and offset; rows with a ``partition`` column
    use their own.  A record that is not JSON becomes the ``message`` of one.
    """
    place = F.col("partition") if "partition" in logs.columns else F.lit(partition)
    doc_id = F.concat_ws("+", F.lit(topic), place.cast("string"), F.col("seq").cast("string"))
    record = F.coalesce("record", F.lit(""))
    body = F.when(F.try_parse_json(record).isNotNull(), record).otherwise(
        F.to_json(F.struct(record.alias("message"))))
    return logs.select(doc_id.alias("doc_id"), F.lit(topic).alias("index_name"), body.alias("source"))
