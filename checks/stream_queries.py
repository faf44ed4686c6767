"""Streaming runs over the test tables, checked by the SQL of their batch forms.

Each reads its table as a file stream, runs until all input is taken and reads
back what its sink wrote.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from checks.queries import now, query
from feedloom import session
from feedloom.operators import logs, stations, tables, ticks, transit
from feedloom.plans import log_shipping, publishing
from feedloom.plans import trains as train_plan
from feedloom.sinks import writers
from feedloom.streaming import folds, keyed, run, streams

c = F.col

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def _stream(spark, sf: str, name: str, schema: T.StructType) -> DataFrame:
    """A table, one file or a folder of many, as a file stream.

    A stream takes a folder as its path, or a pattern; this pattern matches just the table.
    """
    return spark.readStream.schema(schema).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


def _events(spark, sf) -> DataFrame:
    return _stream(spark, sf, "events", EVENTS)


def _run(spark, df: DataFrame, write, mode: str = "append") -> None:
    run.run_available(df, write, session.shared_dir(spark, "checkpoint"), mode)


def _through_files(spark, df: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream wrote, one directory per micro-batch."""
    out = session.shared_dir(spark, "stream")
    _run(spark, df, writers.files(out), mode)
    return spark.read.schema(T.StructType(df.schema.fields + [
        T.StructField(writers.BATCH, T.LongType())])).parquet(out)


@query
def stream_low_availability(spark, sf):
    out = session.shared_dir(spark, "stream")
    write = streams.refreshed_lookup(
        lambda: b.station_info(spark, sf), writers.files(out), stations.low_availability)
    _run(spark, b.station_status(_events(spark, sf)), write)
    return spark.read.parquet(out).select(
        "seq", "station_id", "num_bikes_available", "capacity", "ratio")


def _net_changes(spark, sf, window: str) -> DataFrame:
    """All updates of the streamed change totals."""
    out = session.shared_dir(spark, "stream")
    write = folds.net_delta_writer(session.shared_dir(spark, "state"), writers.files(out), window)
    _run(spark, b.station_status(_events(spark, sf)), write)
    return spark.read.parquet(out)


@query
def stream_net_delta_changelog(spark, sf):
    return _net_changes(spark, sf, "1 day").select(
        "station_id", "window_start", "seq", "num_bikes_available", "net")


@query
def stream_net_delta(spark, sf):
    return tables.latest_per_key(_net_changes(spark, sf, "60 minutes"),
                                 ["station_id", "window_start", "window_end"], "seq", ["net"])


def _dealt(spark, rows: DataFrame, order: str, update, batches: int = 3) -> DataFrame:
    """What ``update`` of a stream of all rows wrote, which arrive in ``batches`` micro-batches, in order.

    The rows are made once and put down by batch; each batch's files then arrive and
    are taken by a run from the checkpoint of the one before.
    """
    made, path = session.shared_dir(spark, "made"), session.shared_dir(spark, "dealt")
    rows.write.parquet(made)
    rows = spark.read.schema(rows.schema).parquet(made)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    part = F.floor((c(order) - low) * batches / (high - low + 1))
    out, checkpoint = session.shared_dir(spark, "stream"), session.shared_dir(spark, "checkpoint")
    for n in range(batches):
        rows.where(part == n).write.mode("append").parquet(path)
        updates = update(spark.readStream.schema(rows.schema).parquet(path))
        run.run_available(updates, writers.files(out), checkpoint)
    return spark.read.schema(T.StructType(updates.schema.fields + [
        T.StructField(writers.BATCH, T.LongType())])).parquet(out)


@query
def stream_keyed_net_delta(spark, sf):
    return _dealt(spark, b.station_status(b.events(spark, sf)), "seq", lambda readings: keyed.net_delta_updates(
        readings, "1 day", lateness=timedelta(days=3650))).select(
        "station_id", "window_start", "seq", "num_bikes_available", "net")


@query
def stream_keyed_improvements(spark, sf):
    return _dealt(spark, train_plan.arrivals(b.trip_topic(b.events(spark, sf))), "seq",
                  lambda arrivals: keyed.arrival_improvements(arrivals, now())).drop(writers.BATCH)


@query
def stream_top_turnover(spark, sf):
    out = session.shared_dir(spark, "stream")
    write = folds.top_turnover_writer(session.shared_dir(spark, "state"), lambda: b.station_info(spark, sf),
                                      writers.files(out), 10, "1 day")
    _run(spark, b.station_status(_events(spark, sf)), write)
    ranked = spark.read.parquet(out)
    # The last ranking of a window is the valid one.
    last = ranked.groupBy("window_start").agg(F.max(writers.BATCH).alias(writers.BATCH))
    return ranked.join(last, ["window_start", writers.BATCH]).select(
        "window_start", "rank", "station_id", "turnover")


@query
def stream_ktable_latest(spark, sf):
    info = stations.decode_info(b.info_topic(_events(spark, sf)))
    changes = _through_files(spark, tables.latest_versions(
        info, ["station_id"], "seq", ["name", "capacity"], c("deleted")), "update")
    return tables.latest_per_key(changes, ["station_id"], writers.BATCH, ["name", "capacity"],
                                 c("deleted"))


@query
def stream_pair_correlation(spark, sf):
    source, out = session.shared_dir(spark, "closing"), session.shared_dir(spark, "stream")
    kind = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("trade_date", T.TimestampType()),
                         T.StructField("price", T.DoubleType())])
    spark.createDataFrame([], kind).write.parquet(source)
    checkpoint = session.shared_dir(spark, "checkpoint")
    pairs = b.pairs(b.events(spark, sf))

    def start(prices: DataFrame) -> None:
        correlations = ticks.pair_correlation(
            ticks.daily_prices(prices.withWatermark("trade_date", "1 day")), pairs)
        run.run_available(correlations, writers.files(out), checkpoint)

    def close() -> None:
        far = b.raw_ticks(b.events(spark, sf)).agg(F.max("trade_date") + F.expr("interval 1 year")).first()[0]
        spark.createDataFrame([("", far, None)], kind).write.mode("append").parquet(source)

    streams.until_closed(start, b.raw_ticks(_events(spark, sf)),
                         spark.readStream.schema(kind).parquet(source), close)
    return spark.read.parquet(out).select(
        "t1", "t2", "window_start", "window_end", F.round("corr", 6).alias("corr"))


@query
def stream_next_arrival(spark, sf):
    arrivals = train_plan.arrivals(b.trip_topic(_events(spark, sf)))
    out = session.shared_dir(spark, "stream")
    _run(spark, arrivals, folds.next_arrival_writer(session.shared_dir(spark, "state"), writers.files(out), now))
    live = spark.read.parquet(out)
    last = live.agg(F.max(writers.BATCH)).scalar()
    return live.where(c(writers.BATCH) == last).drop(writers.BATCH)


def _improvements(spark, sf, write) -> None:
    arrivals = train_plan.arrivals(b.trip_topic(_events(spark, sf)))
    _run(spark, arrivals, folds.improvements_writer(session.shared_dir(spark, "state"), write, now))


@query
def stream_arrival_improvements(spark, sf):
    out = session.shared_dir(spark, "stream")
    _improvements(spark, sf, writers.files(out))
    return spark.read.parquet(out).drop(writers.BATCH)


@query
def stream_countdown(spark, sf):
    out = session.shared_dir(spark, "stream")
    arrivals = train_plan.arrivals(b.trip_topic(_events(spark, sf)))
    _run(spark, arrivals, train_plan.countdown_updates(
        session.shared_dir(spark, "state"), b.stops(spark, sf), now, writers.files(out)))
    return spark.read.parquet(out).select("seq", "message")


@query
def stream_kv_upsert(spark, sf):
    posts = _stream(spark, sf, "documents", DOCUMENTS).select(
        c("doc_id").alias("seq"), F.concat_ws("/", "source", "lang").alias("title"),
        c("text").alias("body"))
    out = session.shared_dir(spark, "entries")
    _run(spark, posts, writers.entries(out, "title", "body", "seq"))
    return writers.read_entries(spark, out, "title", "body")


@query
def stream_save_forms(spark, sf):
    posts = b.posts(spark, sf, _stream(spark, sf, "documents", DOCUMENTS))
    entries, table = session.shared_dir(spark, "entries"), session.shared_dir(spark, "table")
    _run(spark, posts, publishing.save_forms(entries, table))
    drafts = writers.read_entries(spark, entries, "title", "body").withColumn(
        "route", F.lit("entries"))
    saved = spark.read.parquet(table).select("title", "body", F.lit("table").alias("route"))
    return drafts.unionByName(saved)


@query
def stream_log_fan_out(spark, sf):
    records = logs.route_tags(b.logs(_events(spark, sf)))
    objects, docs = session.shared_dir(spark, "objects"), session.shared_dir(spark, "docs")
    _run(spark, records, log_shipping.ship(objects, docs))
    paths = ", ".join(f"{p} string" for p in logs.PATH)
    written = spark.read.schema(f"seq bigint, {paths}").json(objects).groupBy(*logs.PATH).agg(
        F.count(F.lit(1)).alias("records")).withColumn("sink", F.lit("objects"))
    indexed = spark.read.schema("index_name string").json(docs).groupBy(
        c("index_name").alias("sink")).agg(
        F.count(F.lit(1)).alias("records"))
    return written.unionByName(indexed, allowMissingColumns=True)
