"""One query per operator, over the test tables.

Every query takes (spark, directory of the tables) and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from feedloom import schemas, session
from feedloom.functions import times, trains
from feedloom.operators import (alerts, blocks, landing, logs, messages, posts, quality, stations, tables,
                                ticks, transit)
from feedloom.plans import bikeshare, publishing, trading, trains as train_plan
from feedloom.sinks import landing as landing_sink
from feedloom.sinks import published, writers
from feedloom.sources import files, tables as table_sources

c = F.col
LOG_ROUTES = [("error.*", "log-errors"), ("{click,view}.access", "log-web"),
              ("*.**", "log-messages")]
UI_LANGUAGE, DEFAULT_LANGUAGE = "fr", "en"
REPLY = "Five words make one answer"

_registry: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def now():
    return F.lit(b.NOW)


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(session.pin_utc(spark), sf)
    _registry[fn.__name__] = run
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from checks import stream_queries  # noqa: F401  registers itself
    return dict(_registry)


# --- bike share -------------------------------------------------------------

@query
def low_availability(spark, sf):
    ev = b.events(spark, sf)
    return stations.low_availability(b.station_status(ev), b.station_info(spark, sf)).select(
        "seq", "station_id", "num_bikes_available", "capacity", "ratio")


@query
def feed_flatten(spark, sf):
    return stations.flatten_feed(b.status_snapshots(b.events(spark, sf)))


@query
def feed_count(spark, sf):
    return stations.feed_count(b.status_snapshots(b.events(spark, sf)))


@query
def to_topic_json(spark, sf):
    status = bikeshare.publish_status(b.status_snapshots(b.events(spark, sf)))
    info = stations.to_topic(b.station_info(spark, sf), schemas.INFO_RENAMES)
    return status.unionByName(info)


@query
def source_status_feed(spark, sf):
    path = session.shared_dir(spark, "status")
    # One file per snapshot, as a poller leaves them.
    b.status_snapshots(b.events(spark, sf), 1000).write.partitionBy("snapshot").json(path)
    return stations.flatten_feed(files.status_feed(spark, path)).drop("snapshot")


@query
def decode_quarantine(spark, sf):
    topic = b.status_topic(b.events(spark, sf))
    good = stations.decode_status(topic).select("seq", F.lit(False).alias("malformed"))
    bad = bikeshare.set_aside(topic, b.info_topic(b.events(spark, sf))).where("topic = 'status'")
    return good.unionByName(bad.select(c("offset").alias("seq"), F.lit(True).alias("malformed")))


@query
def plan_low_availability(spark, sf):
    ev = b.events(spark, sf)
    sent = bikeshare.low_availability(b.status_topic(ev), b.info_topic(ev))
    # The ratio's rounding differs between engines; its terms do not.
    line = r"^station_id: (.*), longitude null, latitude null, bikes: (\d+), capacity: (\d+), ratio: [\d.]+%$"
    return sent.select("key", *[F.regexp_extract("value", line, n).alias(name) for n, name in
                                ((1, "station_id"), (2, "bikes"), (3, "capacity"))])


@query
def plan_turnover(spark, sf):
    ev = b.events(spark, sf)
    return bikeshare.turnover(b.status_topic(ev), b.info_topic(ev), "1 day").select(
        "station_id", "window_start", "net", "capacity", "turnover")


@query
def decode_status(spark, sf):
    return stations.decode_status(b.status_topic(b.events(spark, sf))).select(
        "station_id", "seq", "num_bikes_available")


@query
def decode_info(spark, sf):
    return stations.decode_info(b.info_topic(b.events(spark, sf))).select(
        "station_id", "seq", "name", "capacity", "deleted")


@query
def quarantine_split(spark, sf):
    topic = b.status_topic(b.events(spark, sf))
    marked = quality.mark_malformed(topic, schemas.STATUS_VALUE)
    return marked.select(c("offset").alias("seq"), "malformed", "value",
                         c("decoded.num_bikes_available").alias("num_bikes_available"))


@query
def ktable_latest(spark, sf):
    return bikeshare.info_table(b.info_topic(b.events(spark, sf))).select(
        "station_id", "name", "capacity")


@query
def asof_lookup(spark, sf):
    ev = b.events(spark, sf)
    return tables.asof_lookup(b.station_status(ev).drop("ts"), b.info_versions(ev),
                              "station_id", "seq", ["capacity"])


def _net(spark, sf, window):
    return stations.net_delta(b.station_status(b.events(spark, sf)), window)


@query
def net_delta(spark, sf):
    return _net(spark, sf, "60 minutes")


@query
def net_delta_daily(spark, sf):
    return _net(spark, sf, "1 day")


@query
def net_delta_changelog(spark, sf):
    return stations.net_delta_changelog(b.station_status(b.events(spark, sf)), "1 day")


@query
def turnover_ratio(spark, sf):
    return stations.turnover_ratio(_net(spark, sf, "60 minutes"), b.station_info(spark, sf)).select(
        "station_id", "window_start", "net", "capacity", "turnover")


@query
def top_turnover(spark, sf):
    daily = stations.turnover_ratio(_net(spark, sf, "1 day"), b.station_info(spark, sf))
    return stations.top_turnover(daily, 10).select(
        "window_start", "rank", "station_id", "turnover")


# --- ticks ------------------------------------------------------------------

@query
def ticks_scan(spark, sf):
    ev = b.events(spark, sf)
    return ticks.union_ticks([ticks.parse_ticks(b.tick_lines(ev, t), t) for t in b.tickers(ev)])


@query
def source_tick_files(spark, sf):
    ev, path = b.events(spark, sf), session.shared_dir(spark, "ticks")
    paths = {t: f"{path}/{t}" for t in b.tickers(ev)}
    for ticker, target in paths.items():
        b.tick_lines(ev, ticker).write.text(target)
    return files.tick_files(spark, paths)


@query
def pair_fanout(spark, sf):
    return ticks.pair_fanout(b.ticks(b.events(spark, sf)), b.pairs(b.events(spark, sf))).select(
        "t1", "t2", "ticker", "trade_date", F.round("price", 6).alias("price"))


@query
def cogroup_counts(spark, sf):
    return ticks.cogroup_counts(b.ticks(b.events(spark, sf)), b.pairs(b.events(spark, sf)))


def _correlations(spark, sf):
    return ticks.pair_correlation(b.ticks(b.events(spark, sf)), b.pairs(b.events(spark, sf)))


@query
def pair_correlation(spark, sf):
    return _correlations(spark, sf).withColumn("corr", F.round("corr", 6))


@query
def block_correlation(spark, sf):
    return blocks.all_pairs_correlation(b.ticks(b.events(spark, sf))).withColumn("corr", F.round("corr", 6))


@query
def plan_signals(spark, sf):
    ev = b.events(spark, sf)
    signals = trading.signals(b.ticks(ev), b.tickers(ev))
    return signals.withColumn("corr", F.round("corr", 6))


@query
def pair_signals(spark, sf):
    return ticks.pair_signals(_correlations(spark, sf)).withColumn("corr", F.round("corr", 6))


# --- transit ----------------------------------------------------------------

def _arrivals(spark, sf):
    return train_plan.arrivals(b.trip_topic(b.events(spark, sf))).drop("timestamp")


@query
def feed_entities(spark, sf):
    feed = transit.decode_feed(b.transit_feed_json(b.events(spark, sf)))
    updates = transit.trip_updates(transit.feed_entities(feed))
    return updates.select("seq", "id", "feed_time", "incrementality",
                          c("tripUpdate.trip.routeId").alias("route_id"),
                          F.size("tripUpdate.stopTimeUpdate").alias("stop_times"))


@query
def trip_update_messages(spark, sf):
    feed = transit.decode_feed(b.transit_feed_json(b.events(spark, sf)))
    return transit.trip_update_messages(transit.feed_entities(feed)).select("value")


@query
def stop_times(spark, sf):
    return _arrivals(spark, sf)


@query
def next_arrival(spark, sf):
    return transit.next_arrival(_arrivals(spark, sf), now())


@query
def arrival_improvements(spark, sf):
    return transit.arrival_improvements(b.arrivals(b.events(spark, sf)), now())


@query
def arrival_message(spark, sf):
    better = transit.arrival_improvements(b.arrivals(b.events(spark, sf)), now())
    return transit.arrival_messages(better, b.stops(spark, sf), now()).select("seq", "message")


@query
def stop_lookup(spark, sf):
    return transit.stop_lookup(_arrivals(spark, sf), b.stops(spark, sf)).select(
        "seq", "stop_id", "direction", "stop_name")


@query
def stop_unmatched(spark, sf):
    return transit.stop_unmatched(_arrivals(spark, sf), b.stops(spark, sf))


@query
def feed_merge(spark, sf):
    return transit.feed_merge(b.entities(b.events(spark, sf)), snapshot="snapshot").drop("snapshot")


@query
def feed_malformed(spark, sf):
    sent = b.transit_feed_json(b.events(spark, sf)).withColumn(
        "value", F.when(c("seq") % 9 == 0, F.substring("value", 1, 30)).otherwise(c("value")))
    good = transit.decode_feed(sent).select("seq", F.lit(False).alias("malformed"))
    return good.unionByName(transit.malformed_feed(sent).select("seq", F.lit(True).alias("malformed")))


@query
def source_stops(spark, sf):
    path = session.shared_dir(spark, "stops")
    b.stops(spark, sf).select(c("stop_id").alias("GTFS Stop ID"), c("stop_name").alias("Stop Name")).write.option(
        "header", True).csv(path)
    return files.stops(spark, path)


@query
def plan_countdown(spark, sf):
    topic = b.trip_topic(b.events(spark, sf))
    return train_plan.countdown(topic, b.stops(spark, sf), now()).select(
        "seq", "route_id", "stop_id", "direction", "arrival", "total_minutes", "message")


@query
def effective_arrival(spark, sf):
    return transit.with_effective_arrival(b.schedule(spark, sf)).select(
        "trip_id", "stop_sequence", "sched", "effective_arrival")


@query
def delay_propagation(spark, sf):
    trip_delay = b.trips(spark, sf).select(
        "trip_id", F.when(c("status") == "P", F.lit(120).cast("bigint")).alias("trip_delay"))
    planned = b.schedule(spark, sf).join(trip_delay, "trip_id", "left")
    return transit.delay_propagation(planned).select(
        "trip_id", "stop_sequence", "sched", "effective_delay", "expected")


@query
def trip_completed(spark, sf):
    updates = transit.with_effective_arrival(b.schedule(spark, sf)).select(
        "trip_id", "stop_sequence", c("effective_arrival").alias("time"),
        F.when(c("relationship") == "NO_DATA", 60).alias("uncertainty"))
    # The middle of the schedule's years.
    return transit.trip_completed(updates, F.lit(978307200))


@query
def cancelled_trips(spark, sf):
    trips = b.trips(spark, sf)
    bounds = trips.groupBy("route_id").agg(
        F.expr("sum(start_s) div count(start_s)").alias("middle"), F.max("start_s").alias("last"))
    periods = bounds.select(
        "route_id",
        F.when(c("route_id") != "1-URGENT", c("middle")).alias("period_start"),
        F.when(c("route_id") == "1-URGENT", c("middle"))
        .when(c("route_id") != "5-LOW", c("last")).alias("period_end"))
    feed = trips.where(c("status") != "P")
    return transit.cancelled_trips(trips, periods, feed).select("trip_id", "route_id", "start_s")


@query
def assigned_trips(spark, sf):
    assigned = F.when(c("status") == "F", True).when(c("status") == "O", False)
    return transit.assigned_trips(b.trips(spark, sf).withColumn("is_assigned", assigned)).select(
        "trip_id", "route_id")


@query
def service_time(spark, sf):
    rows = b.trips(spark, sf).select(
        "trip_id", F.date_format("day", "yyyyMMdd").alias("start_date"),
        F.format_string("%02d:%02d:%02d", c("custkey") % 30, c("trip_id") % 60,
                        c("custkey") % 60).alias("start_time"))
    return rows.withColumn("start_s", times.service_time(c("start_date"), c("start_time")))


@query
def train_id_parts(spark, sf):
    kind = F.when(c("status") == "P", "0").when(c("status") == "F", "=").otherwise("/")
    mark = F.when(c("custkey") % 2 == 0, "+").otherwise(" ")
    train = F.concat(
        kind, F.substring("route_id", 1, 1), F.lit(" "),
        F.format_string("%02d%02d", c("custkey") % 24, c("trip_id") % 60), mark, F.lit(" "),
        F.upper(F.substring("route_id", 3, 3)), F.lit("/BBR"))
    rows = b.trips(spark, sf).select("trip_id", train.alias("train_id"))
    return rows.select("trip_id", "train_id", *trains.train_id_parts(c("train_id")))


def _tracks(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("trip_id"), c("l_linenumber").alias("stop_sequence"),
        (c("l_linenumber") % 4 + 1).alias("scheduled_track"),
        F.when(c("l_tax") > 0, (c("l_suppkey") % 4 + 1).cast("int")).alias("actual_track"))


@query
def rerouted_stops(spark, sf):
    rows = _tracks(spark, sf)
    return rows.where(trains.is_rerouted(c("scheduled_track"), c("actual_track")))


@query
def countdown_stops(spark, sf):
    return transit.without_rerouted(_tracks(spark, sf)).select("trip_id", "stop_sequence")


@query
def vehicle_status(spark, sf):
    ev = b.events(spark, sf)
    status = F.when(c("event_type") == "view", "STOPPED_AT").when(
        c("event_type") == "click", "INCOMING_AT")
    sequence = F.when(c("value") >= 20, F.floor("value"))
    return ev.select(c("event_id").alias("seq"),
                     trains.vehicle_status(status, sequence).alias("vehicle_status"))


@query
def translated_text(spark, sf):
    entry = F.struct(F.concat_ws("/", "source", "lang").alias("text"), c("lang").alias("language"))
    other = F.struct(
        F.concat(F.lit("doc "), c("doc_id").cast("string")).alias("text"),
        F.when(c("n_chars") % 2 == 0, F.lit("en")).alias("language"))
    docs = b.table(spark, sf, "documents").select("doc_id", F.array(other, entry).alias("t"))
    return docs.select("doc_id", trains.pick_translation(
        c("t"), F.lit(UI_LANGUAGE), DEFAULT_LANGUAGE).alias("text"))


@query
def active_alerts(spark, sf):
    return alerts.active_alerts(b.alerts(b.events(spark, sf)), now()).select("id")


@query
def alert_targets(spark, sf):
    ev = b.events(spark, sf)
    targets = b.stop_updates(ev).select(
        "route_id", F.substring("stop_code", 1, 3).alias("stop_id")).distinct()
    return alerts.alert_targets(b.alerts(ev), targets, ["route_id", "stop_id"])


@query
def alert_targets_selectors(spark, sf):
    ev = b.events(spark, sf)
    targets = b.stop_updates(ev).select(
        "route_id", F.substring("stop_code", 1, 3).alias("stop_id")).distinct()
    return alerts.alert_targets(b.selectors(ev), targets, ["route_id", "stop_id"])


# --- landing, posts, logs, messages -----------------------------------------

def _land(spark, sf) -> str:
    """Land the posts, one run per language."""
    path = session.shared_dir(spark, "landing")
    b.post_json(spark, sf).write.partitionBy(landing.RUN).json(path)
    return path


@query
def posts_load(spark, sf):
    return landing.project_posts(files.posts(spark, _land(spark, sf), multi_line=False)).drop(
        landing.RUN)


@query
def posts_load_malformed(spark, sf):
    path = session.shared_dir(spark, "lines")
    b.post_lines(spark, sf).write.text(path)
    good = files.posts(spark, path, multi_line=False).select("id", F.lit(None).cast("string").alias("value"))
    bad = files.corrupt_posts(spark, path, multi_line=False).select(
        F.lit(None).cast("int").alias("id"), "value")
    return good.unionByName(bad)


@query
def manifest_load(spark, sf):
    path, notices = session.shared_dir(spark, "landing"), session.shared_dir(spark, "manifest")
    rows = b.post_json(spark, sf)
    # Every run is landed, every run but the German one announced; one message has no path.
    for run in [r[0] for r in rows.select(landing.RUN).distinct().collect()]:
        target = landing_sink.land_snapshot(rows.where(c(landing.RUN) == run).drop(landing.RUN), path, run)
        sent = [(target if run != "de" else None,)]
        landing_sink.notify(spark.createDataFrame(sent, "s3_path string"), notices)
    return publishing.load_announced(files.manifest(spark, notices))


@query
def landed_load(spark, sf):
    path, notices = session.shared_dir(spark, "landing"), session.shared_dir(spark, "manifest")
    rows = b.post_json(spark, sf)
    landing_sink.land_runs(rows, path)
    # As in manifest_load: every run but the German one is announced, one of them twice.
    runs = rows.select(landing.RUN).distinct().where(c(landing.RUN) != "de")
    sent = runs.select(F.concat(F.lit(f"{path}/{landing.RUN}="), landing.RUN).alias("s3_path"))
    landing_sink.notify(sent.unionByName(sent.limit(1)), notices)
    return publishing.load_landed(files.manifest(spark, notices), path)


@query
def posts_scan(spark, sf):
    path = session.shared_dir(spark, "posts")
    writers.files(path)(posts.table_rows(b.routed_posts(spark, sf)), 0)
    return table_sources.posts_table(spark, path).select("seq", "title", "body", "date", "author")


@query
def validate_posts(spark, sf):
    return posts.validate_posts(b.posts(spark, sf)).select("seq", "title", "author", "reason")


@query
def route_posts(spark, sf):
    return b.routed_posts(spark, sf).select("seq", "title", "body", "route")


@query
def kv_upsert(spark, sf):
    return tables.upsert_entries(b.posts(spark, sf), "title", "body", "seq")


@query
def published_entries(spark, sf):
    """Entries in four batches by seq, the second one sent again, compacted after the third."""
    path, rows = session.shared_dir(spark, "published"), b.posts(spark, sf)
    last = rows.agg(F.max("seq")).first()[0]
    if last is None:
        return published.read_entries(spark, path, "title", "body")
    part = F.floor(c("seq") * 4 / (last + 1))
    write = published.entries(path, "title", "body", "seq")
    for n in (0, 1, 1, 2):
        write(rows.where(part == n), n)
    published.compact_entries(spark, path, "title", "body")
    write(rows.where(part == 3), 3)
    return published.read_entries(spark, path, "title", "body")


@query
def log_partitions(spark, sf):
    return logs.partition_counts(b.logs(b.events(spark, sf)))


@query
def tag_route(spark, sf):
    return logs.route_tags(b.logs(b.events(spark, sf)), LOG_ROUTES).select("seq", "tag", "topic")


@query
def tag_route_indexed(spark, sf):
    routes = logs.route_index(spark, LOG_ROUTES)
    return logs.route_tags_by_index(b.logs(b.events(spark, sf)), routes).select("seq", "tag", "topic")


@query
def index_documents(spark, sf):
    return logs.index_documents(b.logs(b.events(spark, sf)))


@query
def word_stream(spark, sf):
    return messages.word_stream(b.messages(spark, sf))


@query
def message_history(spark, sf):
    return messages.message_history(b.messages(spark, sf), page=1000).withColumn(
        "history", F.array_join("history", "\n"))


@query
def message_acks(spark, sf):
    return messages.acknowledgements(b.messages(spark, sf))


@query
def reply_words(spark, sf):
    return messages.reply_words(b.messages(spark, sf), REPLY)
