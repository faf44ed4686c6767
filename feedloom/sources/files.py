"""File sources: feed snapshots, tick files, dimensions, landed posts, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.operators import landing, quality, ticks


def reader(spark: SparkSession, stream: bool = False, max_files: int | None = None):
    """``spark.read`` or ``spark.readStream``; ``max_files`` bounds a micro-batch."""
    if not stream:
        return spark.read
    source = spark.readStream
    return source.option("maxFilesPerTrigger", max_files) if max_files else source


def json_records(spark: SparkSession, path: str | list[str], schema: T.StructType, stream: bool = False,
                 multi_line: bool = False, **options) -> DataFrame:
    """JSON lines, or the elements of multi-line documents, with ``_corrupt_record``:
    the text of a record that cannot be read, null for all others."""
    kept = T.StructType([*schema.fields, T.StructField(quality.CORRUPT, T.StringType())])
    return (reader(spark, stream).schema(kept).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", quality.CORRUPT)
            .options(**options).json(path))


def _with_field(records: DataFrame):
    """True for every row, but not without reading a field of the records: Spark
    refuses queries that need nothing but the text of bad ones, such as counts."""
    field = next(f for f in records.columns if f not in (quality.CORRUPT, landing.RUN))
    return F.hash(field) >= F.lit(-2 ** 31)


def good(records: DataFrame) -> DataFrame:
    """The records that could be read."""
    return records.where(F.col(quality.CORRUPT).isNull() & _with_field(records)).drop(quality.CORRUPT)


def corrupt(records: DataFrame) -> DataFrame:
    """The records that could not: their text, next to the run that names their directory."""
    kept = [f for f in (landing.RUN,) if f in records.columns]
    return records.where(F.col(quality.CORRUPT).isNotNull() & _with_field(records)).select(
        *kept, F.col(quality.CORRUPT).alias("value"))


def json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   stream: bool = False, **options) -> DataFrame:
    """One row per element of multi-line JSON documents (objects or arrays), corrupt ones included."""
    return json_records(spark, path, schema, stream, multi_line=True, **options)


def status_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Status snapshots; see :func:`corrupt_snapshots` for those that cannot be read."""
    return good(json_documents(spark, path, schemas.STATUS_FEED, stream))


def info_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return good(json_documents(spark, path, schemas.INFO_FEED, stream))


def transit_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Transit snapshots in their JSON rendering."""
    return good(json_documents(spark, path, schemas.FEED_MESSAGE, stream))


def corrupt_snapshots(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False) -> DataFrame:
    """The snapshots below ``path`` that the feed readers leave out."""
    return corrupt(json_documents(spark, path, schema, stream))


def transit_feed_binary(df: DataFrame, descriptor: str, message: str = "FeedMessage",
                        value: str = "value") -> DataFrame:
    """Binary transit snapshots, where the spark-protobuf package is deployed."""
    from pyspark.sql.protobuf.functions import from_protobuf
    return df.select(from_protobuf(F.col(value), message, descriptor).alias("_m")).select("_m.*")


def post_records(spark: SparkSession, path: str | list[str], stream: bool = False,
                 multi_line: bool = True, runs: bool = True) -> DataFrame:
    """Landed snapshots of posts, those that cannot be read included.

    Snapshots are JSON arrays as fetched, or JSON lines as Spark lands them;
    lines split across tasks, arrays are read whole.  ``runs`` adds the run that
    a directory names.
    """
    extra = [T.StructField(landing.RUN, T.StringType())] if runs else []
    return json_records(spark, path, T.StructType([*schemas.POST_JSON.fields, *extra]), stream, multi_line)


def posts(spark: SparkSession, path: str | list[str], stream: bool = False,
          multi_line: bool = True) -> DataFrame:
    """The landed posts, in one directory per run; :func:`corrupt_posts` has the rest."""
    return good(post_records(spark, path, stream, multi_line))


def corrupt_posts(spark: SparkSession, path: str | list[str], stream: bool = False,
                  multi_line: bool = True) -> DataFrame:
    return corrupt(post_records(spark, path, stream, multi_line))


def manifest(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return reader(spark, stream).schema(schemas.MANIFEST).json(path)


def tick_files(spark: SparkSession, paths: dict[str, str], stream: bool = False) -> DataFrame:
    """Tick files, one path per ticker, as one keyed table."""
    return ticks.union_ticks([
        ticks.parse_ticks(reader(spark, stream).format("text").load(path), ticker)
        for ticker, path in paths.items()])


def stops(spark: SparkSession, path: str) -> DataFrame:
    """(stop_id, stop_name) of the stop dimension; other columns are ignored."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col("GTFS Stop ID").alias("stop_id"), F.col("Stop Name").alias("stop_name"))


def logs(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Log records (tag, ts, record) as JSON lines; :func:`corrupt_lines` has the rest."""
    return good(json_records(spark, path, schemas.LOG_RECORD, stream))


def form_posts(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Submitted posts as JSON lines; :func:`corrupt_lines` has the rest."""
    return good(json_records(spark, path, schemas.POST_FORM, stream))


def corrupt_lines(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False) -> DataFrame:
    """The JSON lines below ``path`` that the line readers leave out."""
    return corrupt(json_records(spark, path, schema, stream))
