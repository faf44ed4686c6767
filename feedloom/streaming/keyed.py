"""Folds with a state per key, for streams whose stored keys far outnumber a micro-batch's.

The folds of :mod:`feedloom.streaming.folds` rewrite their whole state with every
micro-batch.  Here Spark's ``transformWithState`` holds it in RocksDB: a
micro-batch reads and writes the keys it has rows of, and what it stores does
not grow with the keys that are there already.  The results are the same.

Keys are handed to Python by the hash of the key, ``BUCKETS`` of them at most: a
bucket's rows of one micro-batch are folded together as columns of numbers (about
50 bytes a row), and each of its keys is read from the state once and written once.
The source's limit per trigger bounds the rows of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedloom import session
from feedloom.operators import transit
from feedloom.streaming.folds import confirmed

#: Rows that leave a processor at a time.
CHUNK = 100_000
#: Groups that keys are handed over in; a running query's checkpoint holds it.
BUCKETS = 1024


def with_keyed_state(spark: SparkSession) -> SparkSession:
    """Keyed states need the RocksDB store; its change log holds a batch's changes only."""
    for name in ("spark.sql.streaming.stateStore.providerClass",
                 "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"):
        spark.conf.set(name, session.RECOMMENDED[name])
    return spark


def _in_order(rows: Iterator[pd.DataFrame], columns: list[str], order: str) -> pd.DataFrame:
    return pd.concat([part[columns] for part in rows], ignore_index=True).sort_values(
        order, kind="stable", ignore_index=True)


def _after_seeds(codes: np.ndarray, seeds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values by code, in order, each code's seed before them: codes, values and which are seeds."""
    both = np.concatenate([np.arange(len(seeds)), codes])
    by_code = np.argsort(both, kind="stable")
    return both[by_code], np.concatenate([seeds, values])[by_code], by_code < len(seeds)


def _chunks(out: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for start in range(0, len(out), CHUNK):
        yield out.iloc[start:start + CHUNK]


def _run(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    with_keyed_state(rows.sparkSession)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    return rows.withColumn("_bucket", bucket).groupBy("_bucket").transformWithStateInPandas(
        processor, schema, "append", "None")


# --- change totals ----------------------------------------------------------

class ChangeTotals(StatefulProcessor):
    """Each station's open windows (last reading and total) and its clock.

    A station is one record, as long as its open windows are many: the lateness over
    the length of a window bounds them.
    """

    columns = ["station_id", "start_us", "end_us", "at_us", "seq", "num_bikes_available"]
    #: What is held of a window, as whole numbers of eight bytes.
    window = ["start", "end", "last", "net"]

    def __init__(self, baseline: str, lateness: timedelta):
        if baseline not in ("zero", "first"):
            raise ValueError(f"baseline must be 'zero' or 'first', not {baseline!r}")
        self.baseline, self.lateness = baseline, lateness // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stations = handle.getMapState("stations", "station_id string",
                                           "clock bigint, reached bigint, windows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, self.columns, "seq")
        code, names = pd.factorize(batch["station_id"])
        held = [self.stations.getValue((name,)) or (None, None, b"") for name in names]
        open_until = np.array([np.iinfo(np.int64).min if clock is None else clock - self.lateness
                               for clock, *_ in held], np.int64)
        late = batch["end_us"].to_numpy(np.int64) <= open_until[code]
        windows = self._windows(code[~late], batch[~late], [blob for *_, blob in held])
        net = np.zeros(len(batch), np.int64)
        net[~late] = windows.pop("steps")
        now = batch.groupby(code)["at_us"].max().to_numpy(np.int64)
        moved = [confirmed(clock, reached, int(at)) for (clock, reached, _), at in zip(held, now)]
        closed_until = np.array([np.iinfo(np.int64).min if clock is None else clock - self.lateness
                                 for clock in moved], np.int64)
        left = windows["end"] > closed_until[windows["code"]]
        table = np.stack([windows[name][left] for name in self.window], axis=1)
        ends = np.cumsum(np.bincount(windows["code"][left], minlength=len(names)))
        for i, name in enumerate(names):
            part = table[ends[i - 1] if i else 0:ends[i]]
            self.stations.updateValue((name,), (moved[i], int(now[i]), part.tobytes()))
        yield from _chunks(pd.DataFrame({
            "station_id": batch["station_id"], "start_us": batch["start_us"], "end_us": batch["end_us"],
            "seq": batch["seq"], "num_bikes_available": batch["num_bikes_available"],
            "net": pd.Series(net).astype("Int64").mask(late), "late": late}))

    def _windows(self, code: np.ndarray, batch: pd.DataFrame, blobs: list[bytes]) -> dict[str, np.ndarray]:
        """All open windows, by station, after a batch's readings; ``steps`` are the totals after each reading."""
        known = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, len(self.window))
        stored = np.repeat(np.arange(len(blobs)), [len(x) // (8 * len(self.window)) for x in blobs])
        start, value = (batch[c].to_numpy(np.int64) for c in ("start_us", "num_bikes_available"))
        # The stored windows come first, so that each window's last row here is its newest one.
        rows = pd.DataFrame({"code": np.concatenate([stored, code]), "start": np.concatenate([known[:, 0], start])})
        place = rows.groupby(["code", "start"], sort=True).ngroup().to_numpy()
        n = int(place.max()) + 1 if len(place) else 0
        at, reading = place[:len(known)], place[len(known):]
        entry, total, end, first = (np.zeros(n, np.int64) for _ in range(4))
        if self.baseline == "first":
            first[reading[::-1]] = value[::-1]
        entry[:], end[reading] = first, batch["end_us"].to_numpy(np.int64)
        end[at], entry[at], total[at] = known[:, 1], known[:, 2], known[:, 3]
        codes, values, seed = _after_seeds(reading, entry, value)
        step = np.where(seed, total[codes], np.abs(np.diff(values, prepend=0)))
        net = pd.Series(step).groupby(codes).cumsum().to_numpy(np.int64)
        newest = np.append(codes[1:] != codes[:-1], True)[:len(codes)]
        owner, begin = (np.zeros(n, np.int64) for _ in range(2))
        owner[place], begin[place] = rows["code"], rows["start"]
        steps = np.empty(len(reading), np.int64)
        steps[np.argsort(reading, kind="stable")] = net[~seed]
        return {"code": owner, "start": begin, "end": end, "last": values[newest], "net": net[newest], "steps": steps}

    def close(self) -> None:
        pass


def net_delta_updates(readings: DataFrame, window: str = "60 minutes", baseline: str = "zero",
                      lateness: timedelta = timedelta(days=1)) -> DataFrame:
    """Every update of the per-window change total of a stream of readings.

    Each station has a clock of its own, which moves to a time that two of its
    micro-batches in a row have reached: one bad time stamp closes nothing.  A window
    closes ``lateness`` after its end on that clock and leaves the state.  No reading is
    lost: those of closed windows come out with ``late`` set and no ``net``.  Readings
    without a station, a time or a value are left out.
    """
    at = F.col("ts").cast("timestamp")
    span = F.window(at, window)
    order = dict(readings.dtypes)["seq"]
    rows = readings.where(F.col("station_id").isNotNull() & F.col("num_bikes_available").isNotNull()
                          & at.isNotNull()).select(
        "station_id", F.unix_micros(span["start"]).alias("start_us"), F.unix_micros(span["end"]).alias("end_us"),
        F.unix_micros(at).alias("at_us"), "seq", F.col("num_bikes_available").cast("int").alias("num_bikes_available"))
    folded = _run(rows, ["station_id"], ChangeTotals(baseline, lateness),
                  f"station_id string, start_us bigint, end_us bigint, seq {order}, num_bikes_available int, "
                  "net bigint, late boolean")
    return folded.select("station_id", F.timestamp_micros("start_us").alias("window_start"),
                         F.timestamp_micros("end_us").alias("window_end"), "seq", "num_bikes_available", "net", "late")


# --- arrivals ---------------------------------------------------------------

class EarliestArrival(StatefulProcessor):
    """The earliest arrival that each track has had."""

    def __init__(self, order: str, track: str):
        self.order, self.track = order, track

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getMapState("best", self.track, "arrival bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, list(dict.fromkeys(["seq", self.order, *transit.TRACK, "arrival"])), self.order)
        groups = batch.groupby(transit.TRACK, sort=False)
        code = groups.ngroup().to_numpy()
        tracks = list(batch[transit.TRACK].drop_duplicates().itertuples(index=False, name=None))
        none = np.iinfo(np.int64).max
        held = np.array([none if x is None else x[0] for x in map(self.best.getValue, tracks)], np.int64)
        codes, values, seed = _after_seeds(code, held, batch["arrival"].to_numpy(np.int64))
        best = pd.Series(values).groupby(codes).cummin().to_numpy(np.int64)
        better = np.empty(len(batch), bool)
        better[np.argsort(code, kind="stable")] = (values[1:] < best[:-1])[~seed[1:]]
        last = best[np.append(codes[1:] != codes[:-1], True)]
        for i in np.flatnonzero(last < held):
            self.best.updateValue(tracks[i], (int(last[i]),))
        yield from _chunks(batch.loc[better, ["seq", *transit.TRACK, "arrival"]])

    def close(self) -> None:
        pass


def arrival_improvements(arrivals: DataFrame, now: Column) -> DataFrame:
    """:func:`feedloom.operators.transit.arrival_improvements` of a stream.

    ``now`` is taken once per micro-batch if it is the current time.  Rows of a
    micro-batch follow those of the ones before, whatever their order number.
    """
    order = transit.order_of(arrivals)
    rows = transit.upcoming(arrivals, now).dropna(subset=transit.TRACK).select(
        *dict.fromkeys(["seq", order, *transit.TRACK, "arrival"]))
    kinds = dict(rows.dtypes)
    fields = ", ".join(f"{name} {kinds[name]}" for name in ("seq", *transit.TRACK, "arrival"))
    track = ", ".join(f"{name} {kinds[name]}" for name in transit.TRACK)
    return _run(rows, transit.TRACK, EarliestArrival(order, track), fields)
