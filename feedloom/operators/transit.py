"""Transit feed operators: entities, stop times, next arrivals.

Trip updates are structs in the JSON rendering of the feed (see
:mod:`feedloom.schemas`); arrivals are (seq, route_id, stop_id, direction,
arrival) with ``arrival`` in POSIX seconds and ``seq`` the arrival number of
the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.functions import times
from feedloom.functions.trains import is_rerouted, stop_and_direction
from feedloom.operators import quality, skew

#: What the arrival operators read of a trip update; the parser skips the rest.
ARRIVAL_FIELDS = T.StructType([
    T.StructField("trip", T.StructType([T.StructField("routeId", T.StringType())])),
    T.StructField("stopTimeUpdate", T.ArrayType(T.StructType([
        T.StructField("stopId", T.StringType()),
        T.StructField("arrival", T.StructType([T.StructField("time", T.StringType())]))]))),
])

TRACK = ["route_id", "stop_id", "direction"]

#: Fixed format of a countdown message.
COUNTDOWN = "Next %s bound %s train will arrive at station %s in %d minutes"


def decode_feed(messages: DataFrame, value: str = "value",
                schema: T.StructType = schemas.FEED_MESSAGE) -> DataFrame:
    """Snapshots that arrive as JSON text; columns next to the text are kept.

    A narrower schema makes the parser skip what a query does not read.
    Messages that are no snapshot are left to :func:`malformed_feed`.
    """
    kept = [c for c in messages.columns if c != value]
    text = F.col(value).cast("string")
    decoded = messages.withColumn("_m", quality.once(quality.decode_json(text, schema)))
    good = decoded.where(~quality.is_malformed(F.col("_m"), text))
    return good.select(*kept, *[F.col("_m")[f.name].alias(f.name) for f in schema])


def malformed_feed(messages: DataFrame, value: str = "value",
                   schema: T.StructType = schemas.FEED_MESSAGE) -> DataFrame:
    """The messages that :func:`decode_feed` cannot read, as they came."""
    return quality.quarantine_split(messages, schema, value)[1]


def malformed_trip_updates(topic: DataFrame) -> DataFrame:
    """What :func:`decode_trip_updates` sets aside; empty messages are no records."""
    text = topic.withColumn("value", F.col("value").cast("string")).where(F.length("value") > 0)
    return quality.quarantine_split(text, ARRIVAL_FIELDS)[1]


def feed_entities(feed: DataFrame) -> DataFrame:
    """One row per entity of each snapshot, next to its header's time and mode."""
    kept = [c for c in feed.columns if c not in ("header", "entity")]
    return feed.select(
        *kept, times.posix(F.col("header.timestamp")).alias("feed_time"),
        F.coalesce("header.incrementality", F.lit("FULL_DATASET")).alias("incrementality"),
        F.inline("entity"))


def trip_updates(entities: DataFrame) -> DataFrame:
    """Entities that carry a trip update."""
    return entities.where(F.col("tripUpdate").isNotNull())


def trip_update_messages(entities: DataFrame) -> DataFrame:
    """Trip updates as un-keyed JSON messages."""
    return trip_updates(entities).select(
        F.lit(None).cast("string").alias("key"), F.to_json("tripUpdate").alias("value"))


def decode_trip_updates(topic: DataFrame, on_error: str = "quarantine",
                        schema: T.StructType = ARRIVAL_FIELDS) -> DataFrame:
    """Trip updates of topic messages; empty messages are skipped.

    Values may be text or UTF-8 bytes.
    """
    value = F.col("value").cast("string")
    rows = (topic.where(F.length(value) > 0)
            .withColumn("_u", quality.once(quality.decode_json(value, schema, on_error))))
    if on_error == "quarantine":
        rows = rows.where(F.col("_u").isNotNull() & F.col("_u")[quality.CORRUPT].isNull())
    kept = [c for c in topic.columns if c not in ("key", "value")]
    return rows.select(*kept, *[F.col("_u")[f.name].alias(f.name) for f in schema])


def stop_times(updates: DataFrame) -> DataFrame:
    """One arrival per stop time that names a stop and has an arrival.

    Updates without a trip, its route or stop times give nothing.
    """
    kept = [c for c in updates.columns if c not in ("trip", "stopTimeUpdate")]
    exploded = (updates
                .where(F.col("trip.routeId").isNotNull() & (F.size("stopTimeUpdate") > 0))
                .select(*kept, F.col("trip.routeId").alias("route_id"),
                        F.explode("stopTimeUpdate").alias("_s"))
                .where(F.col("_s.arrival").isNotNull() & F.col("_s.stopId").isNotNull()))
    return exploded.select(*kept, "route_id", *stop_and_direction(F.col("_s.stopId")),
                           times.posix(F.col("_s.arrival.time")).alias("arrival"))


def upcoming(arrivals: DataFrame, now: Column) -> DataFrame:
    """Arrivals at or after ``now`` (POSIX seconds)."""
    return arrivals.where(F.col("arrival") >= now)


def with_countdown(arrivals: DataFrame, now: Column) -> DataFrame:
    """Minutes to arrival: with whole hours discarded, as on a clock, and in full."""
    left = F.col("arrival") - now
    return (arrivals.withColumn("minutes", times.minutes_of_hour(left))
            .withColumn("total_minutes", times.total_minutes(left)))


def next_arrival(arrivals: DataFrame, now: Column) -> DataFrame:
    """Earliest upcoming arrival per route, stop and direction."""
    nearest = upcoming(arrivals, now).groupBy(*TRACK).agg(F.min("arrival").alias("arrival"))
    return with_countdown(nearest, now)


#: The order of arrivals from several partitions, where it is known; else ``seq`` is their order.
ARRIVED = "arrived"


def order_of(arrivals: DataFrame) -> str:
    return ARRIVED if ARRIVED in arrivals.columns else "seq"


def arrival_improvements(arrivals: DataFrame, now: Column, hot: DataFrame | None = None) -> DataFrame:
    """Upcoming arrivals earlier than every one seen before for their track.

    Seen before is what has a smaller ``arrived`` (see
    :func:`feedloom.sources.topics.arrival_number`), without that column a smaller
    ``seq``.  A stored arrival does not expire: once a train has passed, only an even
    earlier upcoming one would count.  ``hot`` spreads the tracks it names; it is made
    from the same order column.
    """
    order = order_of(arrivals)
    known = upcoming(arrivals, now).dropna(subset=TRACK).select(
        "seq", *TRACK, "arrival", *([] if order == "seq" else [order]))
    rows = known if hot is None else skew.with_slices(known, TRACK, order, hot)
    before = (Window.partitionBy(*TRACK, *([] if hot is None else [skew.SLICE])).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    arrival, best = F.col("arrival"), F.min("arrival").over(before)
    better = (rows.withColumn("_best", best)
              .where(F.col("_best").isNull() | (arrival < F.col("_best"))).drop("_best"))
    if hot is not None:
        # Only improvements within a slice can be improvements over all.
        summary = (rows.where(skew.HOT).groupBy(*TRACK, skew.SLICE)
                   .agg(F.min("arrival").alias("_slice_best")))
        better = skew.with_carry(better, TRACK, summary, {
            "_carry": lambda ordered, earlier: F.min("_slice_best").over(earlier)})
        better = better.where(F.col("_carry").isNull() | (arrival < F.col("_carry")))
    return better.select("seq", *TRACK, "arrival")


def stop_lookup(arrivals: DataFrame, stops: DataFrame) -> DataFrame:
    """Add the stop's name; arrivals at unknown stops keep a null name."""
    return arrivals.join(stops.select("stop_id", "stop_name"), "stop_id", "left")


def stop_unmatched(arrivals: DataFrame, stops: DataFrame) -> DataFrame:
    """Stops that arrivals name and the dimension does not know, with their counts."""
    counted = arrivals.groupBy("stop_id").agg(F.count(F.lit(1)).alias("arrivals"))
    return counted.join(stops.select("stop_id"), "stop_id", "left_anti")


def arrival_messages(arrivals: DataFrame, stops: DataFrame, now: Column) -> DataFrame:
    """The countdown message of each arrival; needs a stop name."""
    named = with_countdown(stop_lookup(arrivals, stops), now)
    text = F.format_string(COUNTDOWN, "direction", "route_id", "stop_name", "minutes")
    return named.where(F.col("stop_name").isNotNull()).withColumn("message", text)


# --- documented rules of the feed -------------------------------------------

def feed_merge(entities: DataFrame, order: str = "seq", snapshot: str | None = None) -> DataFrame:
    """Current entities of a feed: last per id, deletions removed.

    ``entities`` is (id, seq, is_deleted, value columns...).  A differential
    snapshot updates what is there.  Where the column ``incrementality`` is
    given, the newest ``FULL_DATASET`` snapshot replaces all before it: entities
    of older snapshots are gone even if it does not name them.  ``snapshot``
    numbers the snapshots; without it, each ``order`` value is one.
    """
    snapshot = snapshot or order
    rows = entities
    if "incrementality" in entities.columns:
        full = F.coalesce("incrementality", F.lit("FULL_DATASET")) == "FULL_DATASET"
        newest = entities.where(full).agg(F.max(snapshot)).scalar()
        rows = entities.where(newest.isNull() | (F.col(snapshot) >= newest)).drop("incrementality")
    values = [c for c in rows.columns if c not in ("id", "is_deleted")]
    by = F.col(order)
    return (rows.groupBy("id")
            .agg(*[F.max_by(v, by).alias(v) for v in values],
                 F.max_by(F.coalesce("is_deleted", F.lit(False)), by).alias("is_deleted"))
            .where(~F.col("is_deleted")).drop("is_deleted"))


def full_dataset(entities: DataFrame) -> DataFrame:
    """Entities of the newest full snapshot; each one replaces all before it."""
    newest = entities.agg(F.max("feed_time").alias("feed_time"))
    return entities.join(F.broadcast(newest), "feed_time", "left_semi")


def with_effective_arrival(stops: DataFrame) -> DataFrame:
    """A given time wins over a delay; a delay counts from the schedule."""
    return stops.withColumn("effective_arrival",
                            F.coalesce("time", F.col("sched") + F.col("delay")))


def delay_propagation(schedule: DataFrame) -> DataFrame:
    """The delay in force at each scheduled stop.

    ``schedule`` is (trip_id, stop_sequence, sched, relationship, delay, time,
    trip_delay): the planned stops left-joined with their updates, where
    ``relationship`` is null without an update.  A given time wins over a delay.
    A stop's delay holds for the following stops until the next update;
    ``NO_DATA`` or an update without time and delay resets it to unknown.
    ``SKIPPED`` stops pass the delay on.  The trip's own delay holds until the
    first stop whose update gives a time or a delay.

    A trip has some tens of stops: one window on the trip, which also serves a
    join on it.
    """
    speaks = F.col("relationship").isNotNull() & (F.col("relationship") != "SKIPPED")
    delay = F.when(F.col("relationship") != "NO_DATA",
                   F.coalesce(F.col("time") - F.col("sched"), F.col("delay")))
    upto = (Window.partitionBy("trip_id").orderBy("stop_sequence")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    updates = (schedule.dropna(subset=["trip_id"])
               .withColumn("_update", F.when(speaks, F.struct(delay.alias("d"))))
               .withColumn("_last", F.last("_update", ignorenulls=True).over(upto))
               .withColumn("_given", F.count("_update.d").over(upto)))
    in_force = F.when(F.col("_given") == 0, F.col("trip_delay")).otherwise(F.col("_last.d"))
    return updates.select(
        *schedule.columns, in_force.cast("bigint").alias("effective_delay"),
        (F.col("sched") + in_force).cast("bigint").alias("expected"))


def trip_completed(updates: DataFrame, now: Column) -> DataFrame:
    """Whether each trip is over, by the update of its last stop.

    ``updates`` is (trip_id, stop_sequence, time, uncertainty).  A past time
    completes the trip, unless an uncertainty other than 0 marks it as a wrong
    prediction.
    """
    last = updates.groupBy("trip_id").agg(
        F.max("stop_sequence").alias("last_sequence"),
        F.max_by("time", "stop_sequence").alias("last_time"),
        F.max_by("uncertainty", "stop_sequence").alias("uncertainty"))
    past = F.coalesce(F.col("last_time") < now, F.lit(False))
    wrong = past & (F.coalesce("uncertainty", F.lit(0)) != 0)
    return (last.withColumn("wrong_prediction", wrong)
            .withColumn("completed", past & ~wrong).drop("uncertainty"))


#: Bounds of periods without a start or end.
_EVER, _NEVER = -(1 << 63), (1 << 63) - 1


def cancelled_trips(schedule: DataFrame, periods: DataFrame, feed: DataFrame,
                    hot: DataFrame | None = None) -> DataFrame:
    """Scheduled trips that start in their route's replacement period but are not in the feed.

    ``schedule`` is (trip_id, route_id, start_s), ``periods`` (route_id,
    period_start, period_end) with null bounds for infinity, ``feed`` (trip_id).

    One ordered pass per route: a trip is inside some period if the latest end of
    the periods that have begun lies after it, however they overlap.  No trip
    meets the periods one by one.  ``hot`` spreads the routes it names (by
    ``start_s``).  A trip without a start is inside a period without bounds only.
    """
    left = schedule.join(feed.select("trip_id"), "trip_id", "left_anti").where(F.col("route_id").isNotNull())
    begun = periods.where(F.col("route_id").isNotNull()).select(
        "route_id", F.coalesce("period_start", F.lit(_EVER)).cast("bigint").alias("start_s"),
        F.coalesce("period_end", F.lit(_NEVER)).cast("bigint").alias("_end"))
    trip = F.struct(*[F.col(c) for c in schedule.columns])
    known = left.where(F.col("start_s").isNotNull()).select(
        "route_id", F.col("start_s").cast("bigint").alias("start_s"), trip.alias("_trip"))
    rows = known.unionByName(begun, allowMissingColumns=True)
    if hot is not None:
        rows = skew.with_slices(rows, ["route_id"], "start_s", hot)
    upto = (Window.partitionBy("route_id", *([] if hot is None else [skew.SLICE])).orderBy("start_s")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    swept = rows.withColumn("_latest", F.max("_end").over(upto)).where(F.col("_trip").isNotNull())
    latest = F.col("_latest")
    if hot is not None:
        summary = rows.where(skew.HOT).groupBy("route_id", skew.SLICE).agg(F.max("_end").alias("_slice_end"))
        swept = skew.with_carry(swept, ["route_id"], summary, {
            "_carry": lambda ordered, earlier: F.max("_slice_end").over(earlier)})
        latest = F.greatest("_latest", "_carry")
    inside = swept.where(F.col("start_s") < latest).select("_trip.*")
    always = begun.where((F.col("start_s") == _EVER) & (F.col("_end") == _NEVER)).select("route_id").distinct()
    unknown = left.where(F.col("start_s").isNull()).join(always, "route_id", "left_semi")
    return inside.select(*schedule.columns).unionByName(unknown.select(*schedule.columns))


def without_rerouted(stops: DataFrame) -> DataFrame:
    """Stops of trips that run on their scheduled tracks.

    One rerouted stop makes a trip's predictions unreliable, so all of its
    stops leave the countdown.
    """
    rerouted = (stops.where(is_rerouted(F.col("scheduled_track"), F.col("actual_track")))
                .select("trip_id").distinct())
    return stops.join(rerouted, "trip_id", "left_anti")


def assigned_trips(trips: DataFrame) -> DataFrame:
    """Trips assigned to a physical train."""
    return trips.where(F.coalesce("is_assigned", F.lit(False)))


def replacement_periods(feed: DataFrame) -> DataFrame:
    """(route_id, period_start, period_end) declared in feed headers."""
    listed = F.col("header").getField(schemas.HEADER_EXTENSION)["tripReplacementPeriod"]
    return feed.select(F.explode(listed).alias("_p")).select(
        F.col("_p.routeId").alias("route_id"),
        times.posix(F.col("_p.replacementPeriod.start")).alias("period_start"),
        times.posix(F.col("_p.replacementPeriod.end")).alias("period_end"))
