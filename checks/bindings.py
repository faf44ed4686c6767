"""Record views over the test tables.

Each view reads its whole table.  Missing values, malformed records and
unmatched keys come from the data: which stations are unknown follows from the
supplier table's size, what is malformed from an event's type and value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import trains
from feedloom.operators import posts as post_ops
from feedloom.operators import quality
from feedloom.operators import ticks as tick_ops

#: 2024-01-15 00:00:00 UTC, the instant the batch forms take for "now".
NOW = 1705276800

c = F.col


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


# --- bike share -------------------------------------------------------------

def station_status(ev: DataFrame) -> DataFrame:
    return ev.select(c("event_id").alias("seq"), "ts", c("user_id").cast("string").alias("station_id"),
                     F.floor("value").cast("int").alias("num_bikes_available"))


def station_info(spark: SparkSession, sf: str) -> DataFrame:
    nation = c("s_nationkey")
    return table(spark, sf, "supplier").select(
        c("s_suppkey").cast("string").alias("station_id"), c("s_name").alias("name"),
        nation.cast("float").alias("lat"), (-nation).cast("float").alias("lon"),
        ((nation % 7) * 20).cast("int").alias("capacity"))


def status_records(ev: DataFrame) -> DataFrame:
    """Full status records, with the arrival number and time next to them."""
    return station_status(ev).select(
        "seq", "ts", "station_id", "num_bikes_available",
        (c("num_bikes_available") % 3).alias("num_bikes_disabled"),
        (c("num_bikes_available") % 5).alias("num_docks_available"),
        F.lit(0).alias("num_docks_disabled"), F.lit(1).alias("is_installed"),
        F.lit(1).alias("is_renting"), F.lit(1).alias("is_returning"))


_STATUS = [f.name for f in schemas.STATION_STATUS]


def status_snapshots(ev: DataFrame, size: int = 100) -> DataFrame:
    """Feed snapshots of ``size`` consecutive records each."""
    return (status_records(ev)
            .groupBy(F.expr(f"seq div {size}").alias("snapshot"))
            .agg(F.collect_list(F.struct(*_STATUS)).alias("stations"))
            .select("snapshot", F.lit(30).alias("ttl"), F.struct("stations").alias("data")))


def _topic(value: Column, key: Column | None = None) -> list[Column]:
    return [(F.lit(None) if key is None else key).cast("string").alias("key"), value.alias("value"),
            c("ts").cast("timestamp").alias("timestamp"), c("seq").alias("offset")]


def status_topic(ev: DataFrame) -> DataFrame:
    """Keyed status records as JSON; small readings of error events are cut off."""
    rows = ev.select("*", c("event_id").alias("seq"))
    value = F.floor("value").cast("int")
    full = F.to_json(F.struct(
        c("user_id").cast("string").alias("stationId"), value.alias("num_bikes_available"),
        (value % 3).alias("num_bikes_disabled"), (value % 5).alias("num_docks_available"),
        F.lit(0).alias("num_docks_disabled"), F.lit(1).alias("is_installed"),
        F.lit(1).alias("is_renting"), F.lit(1).alias("is_returning")))
    cut = (c("event_type") == "error") & (c("value") < 10)
    json = F.when(cut, F.substring(full, 1, 20)).otherwise(full)
    return rows.withColumn("_json", quality.once(json)).select(
        *_topic(c("_json"), c("user_id").cast("string")))


def info_topic(ev: DataFrame) -> DataFrame:
    """Versions of station information; a version without capacity is a deletion."""
    rows = ev.where(c("event_type") == "signup").select("*", c("event_id").alias("seq"))
    capacity = F.floor("value").cast("int")
    value = F.to_json(F.struct(
        c("user_id").cast("string").alias("stationId"),
        F.concat(F.lit("Station "), c("user_id").cast("string")).alias("name"),
        capacity.alias("capacity")))
    return rows.withColumn("_json", quality.once(F.when(capacity > 0, value))).select(
        *_topic(c("_json"), c("user_id").cast("string")))


def info_versions(ev: DataFrame) -> DataFrame:
    return ev.where(c("event_type") == "signup").select(
        c("event_id").alias("seq"), c("user_id").cast("string").alias("station_id"),
        F.nullif(F.floor("value").cast("int"), F.lit(0)).alias("capacity"))


# --- ticks ------------------------------------------------------------------

def tick_lines(ev: DataFrame, ticker: str) -> DataFrame:
    """One ticker's file: a header line, then ``date,price,id`` lines."""
    header = ev.sparkSession.range(0, 1, 1, 1).select(F.lit("date,price,id").alias("value"))
    lines = ev.where(c("event_type") == ticker).select(F.concat_ws(
        ",", F.date_format("ts", "yyyy/MM/dd"), c("value").cast("string"),
        c("event_id").cast("string")).alias("value"))
    return header.unionByName(lines)


def raw_ticks(ev: DataFrame) -> DataFrame:
    return ev.select(c("event_type").alias("ticker"), c("ts").cast("timestamp").alias("trade_date"),
                     c("value").alias("price"))


def tickers(ev: DataFrame) -> list[str]:
    """All tickers that the table holds, in order."""
    return sorted(r[0] for r in ev.select("event_type").distinct().collect())


def pairs(ev: DataFrame) -> list[tuple[str, str]]:
    return tick_ops.pairs_of(tickers(ev))


def ticks(ev: DataFrame) -> DataFrame:
    """One price per (ticker, day)."""
    return tick_ops.daily_prices(raw_ticks(ev))


# --- transit ----------------------------------------------------------------

def _stop_code() -> Column:
    return F.concat(F.lpad((c("user_id") % 1000).cast("string"), 3, "0"),
                    F.when(c("event_id") % 2 == 0, "N").otherwise("S"))


def _arrival() -> Column:
    return F.unix_seconds(c("ts").cast("timestamp")) + F.floor(c("value") * 60)


def _trip_update() -> Column:
    """A trip update with one complete stop time, one without arrival, one without stop.

    Small readings of error events have no trip, large readings no stop times.
    """
    def stop_time(stop, arrival, departure) -> Column:
        none = F.lit(None)
        event = "struct<time:string>"
        return F.struct(
            (none if stop is None else stop).cast("string").alias("stopId"),
            (none if arrival is None else F.struct(arrival.cast("string").alias("time")))
            .cast(event).alias("arrival"),
            (none if departure is None else F.struct(departure.cast("string").alias("time")))
            .cast(event).alias("departure"))

    trip = F.struct(F.concat(F.lit("T"), c("event_id").cast("string")).alias("tripId"),
                    c("event_type").alias("routeId"))
    times = F.array(stop_time(_stop_code(), _arrival(), None),
                    stop_time(_stop_code(), None, _arrival()),
                    stop_time(None, _arrival(), None))
    return F.struct(
        F.when(~((c("event_type") == "error") & (c("value") < 5)), trip).alias("trip"),
        F.when(c("value") < 250, times).alias("stopTimeUpdate"))


def trip_topic(ev: DataFrame) -> DataFrame:
    """Trip updates as un-keyed JSON messages."""
    rows = ev.withColumn("_json", quality.once(F.to_json(_trip_update())))
    return rows.select("*", c("event_id").alias("seq")).select(*_topic(c("_json")))


def transit_feed_json(ev: DataFrame) -> DataFrame:
    """Feed snapshots as JSON text: a trip update entity and a vehicle entity each."""
    now = F.unix_seconds(c("ts").cast("timestamp")).cast("string")
    vehicle = F.struct(_stop_code().alias("stopId"), now.alias("timestamp"))
    entity = F.struct(F.lit("").alias("id"), _trip_update().alias("tripUpdate"),
                      vehicle.alias("vehicle"))

    def made(prefix: str, keep: str) -> Column:
        ident = F.concat(F.lit(prefix), c("event_id").cast("string"))
        dropped = "vehicle" if keep == "tripUpdate" else "tripUpdate"
        return entity.withField("id", ident).withField(
            dropped, F.when(F.lit(False), entity[dropped]))

    message = F.struct(
        F.struct(F.lit("2.0").alias("gtfsRealtimeVersion"), now.alias("timestamp")).alias("header"),
        F.array(made("T", "tripUpdate"), made("V", "vehicle")).alias("entity"))
    return ev.withColumn("_json", quality.once(F.to_json(message))).select(
        c("event_id").alias("seq"), c("_json").alias("value"))


def stop_updates(ev: DataFrame) -> DataFrame:
    return ev.select(c("event_id").alias("seq"), c("event_type").alias("route_id"),
                     _stop_code().alias("stop_code"), _arrival().alias("arrival"))


def arrivals(ev: DataFrame) -> DataFrame:
    """Arrivals as a table that holds them decoded."""
    return stop_updates(ev).select("seq", "route_id", *trains.stop_and_direction(c("stop_code")),
                                   "arrival")


def stops(spark: SparkSession, sf: str) -> DataFrame:
    stop_id = F.lpad((c("s_suppkey") % 1000).cast("string"), 3, "0")
    return (table(spark, sf, "supplier").groupBy(stop_id.alias("stop_id"))
            .agg(F.min("s_name").alias("stop_name")))


def entities(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat_ws("/", c("event_type"), _stop_code()).alias("id"), c("event_id").alias("seq"),
        (c("value") < 10).alias("is_deleted"), _arrival().alias("arrival"),
        F.expr("event_id div 100").alias("snapshot"),
        F.when(F.expr("event_id div 100 % 4") == 0, "FULL_DATASET").otherwise("DIFFERENTIAL")
        .alias("incrementality"))


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    """(trip_id, stop_sequence, sched, delay, time, relationship); delays on some stops."""
    ship = F.unix_seconds(c("l_shipdate").cast("timestamp"))
    rows = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("trip_id"), c("l_linenumber").cast("bigint").alias("stop_sequence"),
        ship.alias("sched"),
        F.when(c("l_quantity") % 5 == 0, (c("l_quantity") * 60).cast("bigint")).alias("delay"),
        F.when(c("l_discount") == 0, ship + (c("l_quantity") * 30).cast("bigint")).alias("time"),
        (c("l_tax") > 0.07).alias("silent"))
    return (rows.groupBy("trip_id", "stop_sequence")
            .agg(F.min("sched").alias("sched"), F.max("delay").alias("delay"),
                 F.max("time").alias("time"), F.max("silent").alias("_silent"))
            .withColumn("relationship", F.when(c("delay").isNotNull() | c("time").isNotNull(), "SCHEDULED")
                        .when(c("_silent"), "NO_DATA")).drop("_silent"))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        c("o_orderkey").alias("trip_id"), c("o_orderpriority").alias("route_id"),
        F.unix_seconds(c("o_orderdate").cast("timestamp")).alias("start_s"),
        c("o_orderstatus").alias("status"), c("o_custkey").alias("custkey"),
        c("o_orderdate").alias("day"))


def alerts(ev: DataFrame) -> DataFrame:
    """Alerts with no period, one, or two; starts and ends may be open."""
    at = F.unix_seconds(c("ts").cast("timestamp"))
    start = F.when(c("event_id") % 7 != 0, at)
    end = F.when(c("event_id") % 11 != 0, at + F.floor(c("value") * 3600))
    kind = "struct<start:bigint,end:bigint>"
    first = F.struct(start.alias("start"), end.alias("end")).cast(kind)
    second = F.struct((at + 864000).alias("start"), (at + 950400).alias("end")).cast(kind)
    periods = (F.when(c("event_type") == "view", F.array().cast(f"array<{kind}>"))
               .when(c("event_type") == "click", F.array(first, second))
               .otherwise(F.array(first)))
    return ev.select(
        c("event_id").alias("id"), periods.alias("active_period"),
        F.when(c("event_id") % 3 != 0, c("event_type")).alias("route_id"),
        F.when(c("event_id") % 5 != 0, F.lpad((c("user_id") % 1000).cast("string"), 3, "0"))
        .alias("stop_id"))


def selectors(ev: DataFrame) -> DataFrame:
    """The selectors of the alerts: an even alert also names its stop by itself."""
    first = alerts(ev).select("id", "route_id", "stop_id")
    second = ev.where(c("event_id") % 2 == 0).select(
        c("event_id").alias("id"), F.lit(None).cast("string").alias("route_id"),
        F.lpad((c("user_id") % 1000).cast("string"), 3, "0").alias("stop_id"))
    return first.unionByName(second)


# --- posts, logs, messages --------------------------------------------------

def post_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Posts as JSON lines; every seventh is cut off after its id."""
    rows = post_json(spark, sf).drop("ingest_ts")
    line = F.to_json(F.struct(*rows.columns))
    return rows.select(F.when(c("id") % 7 == 0, F.concat(F.lit('{"id":'), c("id").cast("string")))
                       .otherwise(line).alias("value"))


def posts(spark: SparkSession, sf: str, documents: DataFrame | None = None) -> DataFrame:
    """Forms with repeated titles, bad dates and missing authors.

    Given documents, a stream, meet the labels by a shuffle at every size: labels that
    are broadcast while few would make its shuffled bytes jump once they are many.
    """
    labels = table(spark, sf, "labels")
    if documents is None:
        documents = table(spark, sf, "documents")
    else:
        labels = labels.hint("merge")
    return documents.join(labels, "doc_id", "left").select(
        c("doc_id").alias("seq"), F.concat_ws("/", "source", "lang").alias("title"),
        c("text").alias("body"),
        F.when(c("doc_id") % 10 == 0, "2018/07/01").otherwise("2018-07-01").alias("date"),
        F.when(c("toxic").isNotNull(), c("lang")).alias("author"),
        F.when(c("quality") == 0, "draft").otherwise("save").alias("action"))


def post_json(spark: SparkSession, sf: str) -> DataFrame:
    """Posts as an upstream API returns them, with the run that lands them."""
    return table(spark, sf, "documents").select(
        c("doc_id").cast("int").alias("id"), F.substring("source", 4, 9).cast("int").alias("userId"),
        F.concat_ws("/", "source", "lang").alias("title"), c("text").alias("body"),
        c("lang").alias("ingest_ts"))


def routed_posts(spark: SparkSession, sf: str) -> DataFrame:
    return post_ops.route_posts(posts(spark, sf))


def logs(ev: DataFrame) -> DataFrame:
    return ev.select(c("event_id").alias("seq"),
                     F.concat(c("event_type"), F.lit(".access")).alias("tag"),
                     "ts", c("props").alias("record"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "text")
