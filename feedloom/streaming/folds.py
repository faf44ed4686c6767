"""Folds over micro-batches whose state is a small table.

Each fold takes a micro-batch and the state after the one before, and gives the
changes and the new state, with DataFrame operations only: a batch's rows of one
key follow the key's stored state in an ordinary window.  States are stored
whole, in one of three places in turn, so a replayed batch finds the state it
started from and storage does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators import stations, transit
from feedloom.sinks.writers import BatchWriter, files

LATENESS = "1 day"
PLACES = 3


@dataclass(frozen=True)
class StateTable:
    """A state below ``path``, written once per micro-batch."""

    path: str
    schema: str

    def _place(self, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}/state-{batch_id % PLACES}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after the micro-batch before; none before the first one."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._place(batch_id - 1))

    def put(self, state: DataFrame, batch_id: int) -> DataFrame:
        """Store the state after a micro-batch and read it back."""
        state.write.mode("overwrite").parquet(self._place(batch_id))
        return state.sparkSession.read.schema(self.schema).parquet(self._place(batch_id))


# --- change totals ----------------------------------------------------------

WINDOW_KEYS = ["station_id", "window_start", "window_end"]
NET_STATE = ("station_id string, window_start timestamp, window_end timestamp, "
             "seq {order}, last_bikes int, net bigint, seen timestamp, reached timestamp")
#: Stations that must have reached a time for it to move the clock, if a batch has as many.
WITNESSES = 2


def reached(rows: DataFrame, witnesses: int = WITNESSES):
    """The time that ``witnesses`` stations of a micro-batch have reached, or all of them
    if it has fewer; none for an empty one."""
    newest = rows.groupBy("station_id").agg(F.max("ts").alias("ts")).where(F.col("ts").isNotNull())
    times = [r["ts"] for r in newest.orderBy(F.col("ts").desc()).limit(witnesses).collect()]
    return times[-1] if times else None


def confirmed(clock, last, now):
    """The clock after a micro-batch: the earlier of the times that it and the one before
    have reached, and never back.

    A single record far in the future moves nothing: it needs a second station, or a
    batch of its own station alone, and the same again in the next micro-batch.
    """
    known = [x for x in (last, now) if x is not None]
    both = min(known) if len(known) == 2 else None
    return max((x for x in (clock, both) if x is not None), default=None)


def late_path(path: str) -> str:
    """Where readings that came too late go if no other place is given."""
    return f"{path.rstrip('/')}/late"


def _windowed(batch: DataFrame, window: str) -> DataFrame:
    span = F.window(F.col("ts").cast("timestamp"), window)
    return (batch.where(F.col("station_id").isNotNull() & F.col("num_bikes_available").isNotNull())
            .select("station_id", span["start"].alias("window_start"), span["end"].alias("window_end"),
                    F.col("ts").cast("timestamp").alias("ts"), "seq", "num_bikes_available"))


def net_delta_steps(rows: DataFrame, state: DataFrame, baseline: str = "zero") -> DataFrame:
    """Stored totals and new readings of each window in order, with the total so far.

    ``_stored`` marks the former; a window's readings follow its stored total.
    """
    stored = state.select(*WINDOW_KEYS, "seq", F.col("last_bikes").alias("num_bikes_available"),
                          F.col("net").alias("_net"), F.lit(True).alias("_stored"))
    merged = rows.select(*WINDOW_KEYS, "seq", "num_bikes_available", F.lit(None).cast("bigint").alias("_net"),
                         F.lit(False).alias("_stored")).unionByName(stored)
    order = Window.partitionBy(*WINDOW_KEYS).orderBy(F.col("_stored").desc(), "seq")
    value = F.col("num_bikes_available")
    entry = stations.entry_value(F.lag(value).over(order), value, baseline)
    step = F.when(F.col("_stored"), F.col("_net")).otherwise(F.abs(value - entry).cast("bigint"))
    return merged.withColumn("_step", step).withColumn(
        "net", F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def net_delta_writer(path: str, write: BatchWriter, window: str = "60 minutes", baseline: str = "zero",
                     lateness: str = LATENESS, late: BatchWriter | None = None,
                     totals: Callable[[DataFrame, DataFrame, int], None] | None = None) -> BatchWriter:
    """Every update of the per-window change total, as readings arrive.

    A window closes when the clock of earlier micro-batches (see :func:`confirmed`) is
    ``lateness`` past its end.  No reading is lost: later ones go to ``late``, and
    without it to files below :func:`late_path`.  ``totals`` is called with the stored
    totals of all open windows and the windows that the micro-batch touched.  ``seq``
    may be of any orderable type.
    """
    late = late or files(late_path(path))

    def run(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(path, NET_STATE.format(order=dict(batch.dtypes)["seq"]))
        before = table.before(batch.sparkSession, batch_id)
        clock, last = before.agg(F.max("seen"), F.max("reached")).first()
        bound = F.lit(clock) - F.expr(f"interval {lateness}")
        is_open = F.lit(True) if clock is None else F.col("window_end") > bound
        rows = _windowed(batch, window).persist()
        try:
            steps = net_delta_steps(rows.where(is_open), before.where(is_open & F.col("station_id").isNotNull()),
                                    baseline).persist()
            order = F.struct(~F.col("_stored"), F.col("seq"))
            now = reached(rows)
            state = steps.groupBy(*WINDOW_KEYS).agg(
                F.max_by("seq", order).alias("seq"), F.max_by("num_bikes_available", order).alias("last_bikes"),
                F.max_by("net", order).alias("net"))
            # A row without a station keeps the clock, also when no window is open.
            times = batch.sparkSession.createDataFrame(
                [(confirmed(clock, last, now), now or last)], "seen timestamp, reached timestamp")
            held = table.put(state.unionByName(times, allowMissingColumns=True), batch_id).where(
                F.col("station_id").isNotNull())
            changes = steps.where(~F.col("_stored")).select(*WINDOW_KEYS, "seq", "num_bikes_available", "net")
            write(changes, batch_id)
            if totals is not None:
                totals(held, changes.select("window_start").distinct(), batch_id)
            if clock is not None:
                late(rows.where(~is_open), batch_id)
            steps.unpersist()
        finally:
            rows.unpersist()
    return run


def top_turnover_writer(path: str, read_info: Callable[[], DataFrame], write: BatchWriter, n: int = 10,
                        window: str = "60 minutes", baseline: str = "zero", lateness: str = LATENESS,
                        late: BatchWriter | None = None) -> BatchWriter:
    """The top stations of each window that a micro-batch of readings touched; late
    readings go where :func:`net_delta_writer` puts them."""
    def ranked(held: DataFrame, touched: DataFrame, batch_id: int) -> None:
        totals = held.join(touched, "window_start", "left_semi").select(*WINDOW_KEYS, "net")
        write(stations.top_turnover(stations.turnover_ratio(totals, read_info()), n), batch_id)

    return net_delta_writer(path, lambda changes, batch_id: None, window, baseline, lateness, late, ranked)


# --- arrivals ---------------------------------------------------------------

BEST_STATE = "route_id string, stop_id string, direction string, arrival bigint"


def improvements_writer(path: str, write: BatchWriter, now: Callable[[], Column]) -> BatchWriter:
    """Arrivals earlier than every one seen before for their track.

    ``now`` is asked for each micro-batch.
    """
    table = StateTable(path, BEST_STATE)

    def run(batch: DataFrame, batch_id: int) -> None:
        before = table.before(batch.sparkSession, batch_id)
        rows = transit.upcoming(batch, now()).dropna(subset=transit.TRACK).select(
            "seq", F.col(transit.order_of(batch)).alias("_order"), *transit.TRACK, "arrival",
            F.lit(False).alias("_stored"))
        stored = before.select(*transit.TRACK, "arrival", F.lit(True).alias("_stored"))
        order = Window.partitionBy(*transit.TRACK).orderBy(F.col("_stored").desc(), "_order")
        merged = rows.unionByName(stored, allowMissingColumns=True).withColumn(
            "_best", F.min("arrival").over(order.rowsBetween(Window.unboundedPreceding, -1))).persist()
        try:
            table.put(merged.groupBy(*transit.TRACK).agg(F.min("arrival").alias("arrival")), batch_id)
            better = F.col("_best").isNull() | (F.col("arrival") < F.col("_best"))
            write(merged.where(~F.col("_stored") & better).select("seq", *transit.TRACK, "arrival"), batch_id)
        finally:
            merged.unpersist()
    return run


def next_arrival_writer(path: str, write: BatchWriter, now: Callable[[], Column]) -> BatchWriter:
    """The live next arrival of every track, once per micro-batch.

    The state holds the arrivals still to come; one that has passed at ``now``,
    asked for each micro-batch, leaves it, and the next one takes its place.
    """
    table = StateTable(path, BEST_STATE)

    def run(batch: DataFrame, batch_id: int) -> None:
        at = now()
        rows = batch.dropna(subset=transit.TRACK).select(*transit.TRACK, "arrival")
        coming = transit.upcoming(table.before(batch.sparkSession, batch_id).unionByName(rows), at).distinct()
        write(transit.next_arrival(table.put(coming, batch_id), at), batch_id)
    return run
