"""Bike-share operators: feed flattening, enrichment, turnover.

Readings are rows of (station_id, ts, seq, num_bikes_available), ``seq`` being
the arrival number; station information is (station_id, capacity, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.functions import stations as st
from feedloom.operators import quality, skew

LOW_RATIO = 0.1
#: What the operators read of a status record; the parser skips the rest.
STATUS_READ = T.StructType([schemas.STATUS_VALUE["num_bikes_available"]])


def flatten_feed(feed: DataFrame) -> DataFrame:
    """One row per station of each snapshot ``{ttl, data: {stations: [...]}}``."""
    kept = [c for c in feed.columns if c not in ("ttl", "data")]
    return feed.select(*kept, F.inline("data.stations"))


def feed_count(feed: DataFrame) -> DataFrame:
    """Stations over all snapshots, and snapshots without any."""
    n = F.coalesce(F.size("data.stations"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    return feed.agg(F.count(F.lit(1)).alias("snapshots"),
                    F.coalesce(F.sum(n), F.lit(0)).alias("stations"),
                    F.coalesce(F.sum((n == 0).cast("bigint")), F.lit(0)).alias("empty_snapshots"))


def observe_count(stations: DataFrame, name: str = "feed") -> DataFrame:
    """Report the number of stations as a metric of each batch or micro-batch."""
    return stations.observe(name, F.count(F.lit(1)).alias("stations"))


def to_topic(stations: DataFrame, renames: dict[str, str], key: str = "station_id") -> DataFrame:
    """Keyed topic rows: fields under their topic names, encoded as JSON."""
    fields = [F.col(c).alias(renames.get(c, c)) for c in stations.columns]
    return stations.select(F.col(key).cast("string").alias("key"),
                           F.to_json(F.struct(*fields)).alias("value"))


def _decode(topic: DataFrame, schema: T.StructType, on_error: str):
    decoded = quality.decode_json(F.col("value"), schema, on_error)
    rows = topic.withColumn("_v", quality.once(decoded))
    if on_error == "quarantine":
        rows = rows.where(~quality.is_malformed(F.col("_v"), F.col("value")))
    return rows


def malformed(topic: DataFrame, schema: T.StructType) -> DataFrame:
    """The topic rows that decoding under ``quarantine`` leaves out, as they came.

    Deletions, rows without a value, are no malformed information records.
    """
    return quality.quarantine_split(topic, schema)[1]


def malformed_status(topic: DataFrame) -> DataFrame:
    """What :func:`decode_status` sets aside."""
    return malformed(topic, STATUS_READ)


def malformed_info(topic: DataFrame) -> DataFrame:
    """What :func:`decode_info` sets aside."""
    return malformed(topic.where(F.col("value").isNotNull()), schemas.INFO_VALUE)


def decode_status(topic: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """(station_id, ts, seq, num_bikes_available) of keyed status records.

    The key names the station.  A count missing from a valid record is 0.
    """
    return _decode(topic, STATUS_READ, on_error).select(
        F.col("key").alias("station_id"), F.col("timestamp").alias("ts"),
        F.col("offset").alias("seq"),
        F.coalesce("_v.num_bikes_available", F.lit(0)).alias("num_bikes_available"))


def decode_info(topic: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Station information per record; a null value is a deletion and is kept as such."""
    rows = _decode(topic.where(F.col("value").isNotNull()), schemas.INFO_VALUE, on_error)
    fields = [F.col("_v.name"), F.col("_v.latitude"), F.col("_v.longitude"),
              F.coalesce("_v.capacity", F.lit(0)).alias("capacity")]
    ids = [F.col("key").alias("station_id"), F.col("timestamp").alias("ts"),
           F.col("offset").alias("seq")]
    decoded = rows.select(*ids, *fields, F.lit(False).alias("deleted"))
    deleted = topic.where(F.col("value").isNull())
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in
               (("name", "string"), ("latitude", "float"), ("longitude", "float"),
                ("capacity", "int"))]
    return decoded.unionByName(deleted.select(*ids, *nothing, F.lit(True).alias("deleted")))


def enrich(readings: DataFrame, info: DataFrame, how: str = "left") -> DataFrame:
    """Look up station information by key.

    ``info`` has one row per station.  No broadcast is forced: Catalyst
    broadcasts it while it is below the size threshold, and beyond that AQE
    splits the partitions of a hot station.
    """
    known = info.withColumn("matched", F.lit(True))
    joined = readings.join(known, "station_id", how)
    return joined.withColumn("matched", F.coalesce("matched", F.lit(False)))


def low_availability(readings: DataFrame, info: DataFrame,
                     threshold: float = LOW_RATIO) -> DataFrame:
    """Readings whose bikes-per-dock ratio is strictly below the threshold."""
    ratio = st.availability_ratio(F.col("num_bikes_available"), F.col("capacity"),
                                  F.col("matched"))
    return (enrich(readings, info).withColumn("ratio", ratio)
            .where(F.col("ratio") < threshold).drop("matched"))


def low_availability_lines(alerts: DataFrame) -> DataFrame:
    """Alert rows as keyed topic messages."""
    c = F.col
    line = st.low_availability_line(c("station_id"), c("longitude"), c("latitude"),
                                    c("num_bikes_available"), c("capacity"), c("ratio"))
    return alerts.select(c("station_id").alias("key"), line.alias("value"))


# --- successive readings within tumbling windows ----------------------------

_KEYS = ["station_id", "window_start"]


def _windowed(readings: DataFrame, window: str, hot: DataFrame | None) -> DataFrame:
    rows = (readings
            .where(F.col("station_id").isNotNull() & F.col("num_bikes_available").isNotNull())
            .select("station_id", F.window("ts", window)["start"].alias("window_start"), "seq",
                    F.col("num_bikes_available").alias("_v")))
    return rows if hot is None else skew.with_slices(rows, ["station_id"], "seq", hot)


def _steps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Absolute change to the previous reading of the same keys; null at their first."""
    return rows.withColumn("_step", F.abs(
        F.col("_v") - F.lag("_v").over(Window.partitionBy(*keys).orderBy("seq"))))


def _summaries(stepped: DataFrame, keys: list[str]) -> DataFrame:
    return stepped.groupBy(*keys).agg(
        F.coalesce(F.sum("_step"), F.lit(0)).alias("_inner"),
        F.min_by("_v", "seq").alias("_first"), F.max_by("_v", "seq").alias("_last"),
        F.count(F.lit(1)).alias("_n"))


def entry_value(previous_last, first, baseline: str):
    """The value that the first reading of a window or slice is compared with."""
    if baseline not in ("zero", "first"):
        raise ValueError(f"baseline must be 'zero' or 'first', not {baseline!r}")
    return F.coalesce(previous_last, F.lit(0) if baseline == "zero" else first)


def _nothing():
    return F.lit(None).cast("int")


def _with_window_end(df: DataFrame, window: str) -> DataFrame:
    return df.withColumn("window_end", F.col("window_start") + F.expr(f"interval {window}"))


def net_delta(readings: DataFrame, window: str = "60 minutes", baseline: str = "zero",
              hot: DataFrame | None = None) -> DataFrame:
    """Sum of absolute changes between successive readings, per station and window.

    Readings count in arrival order.  With ``baseline='zero'`` the first
    reading of a window counts as its distance from 0; with ``'first'`` it
    counts nothing.  The input is read and shuffled once; ``hot`` (see
    :func:`feedloom.operators.skew.hot_keys`) spreads the stations it names.
    """
    rows = _windowed(readings, window, hot)
    first = F.col("_first")
    if hot is None:
        folded = _summaries(_steps(rows, _KEYS), _KEYS).select(
            *_KEYS, (F.col("_inner") + F.abs(first - entry_value(_nothing(), first, baseline))
                     ).cast("bigint").alias("net"),
            F.col("_last").alias("last_bikes"), F.col("_n").alias("readings"))
        return _with_window_end(folded, window)
    keys = [*_KEYS, skew.SLICE]
    summary = _summaries(_steps(rows, keys), keys)
    slices = Window.partitionBy(*_KEYS).orderBy(skew.SLICE)
    entry = entry_value(F.lag("_last").over(slices), first, baseline)
    folded = (summary
              .withColumn("_net", F.col("_inner") + F.abs(first - entry))
              .groupBy(*_KEYS)
              .agg(F.sum("_net").cast("bigint").alias("net"),
                   F.max_by("_last", skew.SLICE).alias("last_bikes"),
                   F.sum("_n").alias("readings")))
    return _with_window_end(folded, window)


def net_delta_changelog(readings: DataFrame, window: str = "60 minutes", baseline: str = "zero",
                        hot: DataFrame | None = None) -> DataFrame:
    """Every update of :func:`net_delta`: one row per reading with the total so far."""
    rows = _windowed(readings, window, hot)
    keys = _KEYS if hot is None else [*_KEYS, skew.SLICE]
    frame = (Window.partitionBy(*keys).orderBy("seq")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = (_steps(rows, keys)
               .withColumn("_running", F.coalesce(F.sum("_step").over(frame), F.lit(0)))
               .withColumn("_first", F.first("_v").over(frame)))
    previous, before = _nothing(), F.lit(0)
    if hot is not None:
        summary = _summaries(_steps(rows.where(skew.HOT), keys), keys)
        # Full contribution of a slice needs the last value of the one before it.
        slices = Window.partitionBy(*_KEYS).orderBy(skew.SLICE)
        summary = summary.withColumn("_net", F.col("_inner") + F.abs(
            F.col("_first") - entry_value(F.lag("_last").over(slices), F.col("_first"), baseline)))
        carried = skew.with_carry(
            carried, _KEYS, summary.withColumnRenamed("_last", "_s_last").select(
                *_KEYS, skew.SLICE, "_s_last", "_net"),
            {"_prev_last": lambda ordered, earlier: F.lag("_s_last").over(ordered),
             "_carry_net": lambda ordered, earlier: F.sum("_net").over(earlier)})
        previous, before = F.col("_prev_last"), F.coalesce("_carry_net", F.lit(0))
    net = (before + F.col("_running")
           + F.abs(F.col("_first") - entry_value(previous, F.col("_first"), baseline)))
    return carried.select("station_id", "window_start", "seq",
                          F.col("_v").alias("num_bikes_available"),
                          net.cast("bigint").alias("net"))


def turnover_ratio(net: DataFrame, info: DataFrame) -> DataFrame:
    """Net change as a percentage of capacity; stations without information drop out."""
    joined = net.join(info.select("station_id", "capacity"), "station_id")
    return joined.withColumn("turnover",
                             st.turnover_percent(F.col("net"), F.col("capacity")))


def turnover_lines(turnover: DataFrame) -> DataFrame:
    """Turnover rows as keyed topic messages."""
    return turnover.select(
        F.col("station_id").alias("key"),
        st.turnover_line(F.col("station_id"), F.col("turnover")).alias("value"))


def top_turnover(turnover: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` stations with the highest turnover in each window.

    The rank filter becomes a partial top-n before the shuffle, so at most
    ``n`` rows per window leave a map task.
    """
    ranked = Window.partitionBy("window_start").orderBy(F.col("turnover").desc(), "station_id")
    return (turnover.where(F.col("turnover").isNotNull())
            .withColumn("rank", F.rank().over(ranked)).where(F.col("rank") <= n))
