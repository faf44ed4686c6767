"""States per key: the rows of the batch forms, nothing lost, changes alone written."""

import os
import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom.operators import stations, transit
from feedloom.sinks import writers
from feedloom.streaming import keyed, run

READINGS = "station_id string, ts timestamp, seq bigint, num_bikes_available int"


def stream_of(spark, path, schema, *batches):
    """A stream that takes one given batch per trigger."""
    for data in batches:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def taken(spark, df, tmp_path):
    out = str(tmp_path / "out")
    run.run_available(df, writers.files(out), str(tmp_path / "checkpoint"))
    return spark.read.parquet(out)


def some_readings(n=400, seed=4):
    rng = random.Random(seed)
    return [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else rng.choice("abc"),
             at("2024-01-01") + timedelta(minutes=q), q, None if rng.random() < 0.05 else rng.randint(0, 20))
            for q in range(n)]


@pytest.mark.parametrize("baseline", ["zero", "first"])
def test_totals_over_batches_equal_the_batch_form(spark, rows, tmp_path, baseline):
    data = some_readings()
    batches = [data[i:i + 80] for i in range(0, 400, 80)]
    for part in batches:
        random.Random(1).shuffle(part)
    stream = stream_of(spark, str(tmp_path / "in"), READINGS, *batches)
    got = taken(spark, keyed.net_delta_updates(stream, "60 minutes", baseline), tmp_path)
    assert got.where("late").count() == 0 and got.select(writers.BATCH).distinct().count() >= 5
    want = stations.net_delta_changelog(spark.createDataFrame(data, READINGS), "60 minutes", baseline)
    columns = ["station_id", "window_start", "seq", "num_bikes_available", "net"]
    assert rows(got, *columns) == rows(want, *columns)


def test_a_far_time_closes_nothing_and_late_readings_come_out(spark, rows, tmp_path):
    far, day = at("2100-01-01"), lambda d, m=0: at(f"2024-01-{d:02d} 00:{m:02d}:00")
    stream = stream_of(
        spark, str(tmp_path / "in"), READINGS,
        [("a", far, 1, 7), ("b", day(1), 2, 5)], [("a", day(1), 3, 4), ("b", day(9), 4, 5)],
        [("a", day(1, 1), 5, 6), ("b", day(9, 1), 6, 8), ("c", day(1), 7, 1)],
        [("a", day(1, 2), 8, 6), ("b", day(1, 1), 9, 9), ("b", day(9, 2), 10, 0)])
    got = taken(spark, keyed.net_delta_updates(stream), tmp_path)
    assert rows(got, "seq", "net", "late") == [
        (1, 7, False), (10, 16, False), (2, 5, False), (3, 4, False), (4, 5, False), (5, 6, False),
        (6, 8, False), (7, 1, False), (8, 6, False), (9, None, True)]


def test_an_unknown_baseline_is_refused(spark):
    with pytest.raises(ValueError):
        keyed.ChangeTotals("none", timedelta(days=1))


ARRIVALS = ("seq bigint, arrived decimal(38,0), route_id string, stop_id string, direction string, "
            "arrival bigint")


@pytest.mark.parametrize("arrived", [True, False])
def test_improvements_over_batches_equal_the_batch_form(spark, rows, tmp_path, arrived):
    rng = random.Random(8)
    data = [(rng.randint(0, 9) if arrived else q, Decimal(q), "1", rng.choice(["101", None]), rng.choice("NS"),
             3000 - 3 * q + rng.randint(0, 800)) for q in range(300)]
    drop = [] if arrived else ["arrived"]
    stream = stream_of(spark, str(tmp_path / "in"), ARRIVALS, *[data[i:i + 75] for i in range(0, 300, 75)])
    got = taken(spark, keyed.arrival_improvements(stream.drop(*drop), F.lit(2200)), tmp_path)
    want = transit.arrival_improvements(spark.createDataFrame(data, ARRIVALS).drop(*drop), F.lit(2200))
    assert want.count() > 5 and rows(got, *want.columns) == rows(want)


def logged(path, version):
    """Bytes of the change logs that a state has for a version."""
    return sum(os.path.getsize(os.path.join(folder, name)) for folder, _, names in os.walk(path)
               for name in names if name.startswith(f"{version}.") or name.startswith(f"{version}_"))


def test_a_batch_of_one_key_writes_as_much_over_many_keys_as_over_few(spark, tmp_path):
    sizes = {}
    for stored in (100, 50_000):
        path, checkpoint = str(tmp_path / f"in-{stored}"), str(tmp_path / f"checkpoint-{stored}")
        spark.range(stored).selectExpr(
            "cast(id as string) station_id", "timestamp'2024-01-01' ts", "id seq", "3 num_bikes_available"
        ).coalesce(1).write.parquet(path)
        stream = stream_of(spark, path, READINGS, [("7", at("2024-01-01 00:01:00"), stored, 9)])
        run.run_available(keyed.net_delta_updates(stream), lambda df, n: df.write.format("noop").mode("append").save(),
                          checkpoint)
        sizes[stored] = [logged(os.path.join(checkpoint, "state"), v) for v in (1, 2)]
    assert sizes[50_000][0] > 20 * sizes[100][0]
    assert 0 < sizes[50_000][1] < 1.5 * sizes[100][1]


def plain_totals(batches, window, lateness, baseline):
    """One reading after another, station by station."""
    clocks, open_windows, out = {}, {}, []
    for batch in batches:
        times = {}
        for station, ts, seq, value in sorted(batch, key=lambda r: r[2]):
            if station is None or value is None:
                continue
            start = ts - timedelta(minutes=(ts - at("2024-01-01")) // timedelta(minutes=1) % window)
            clock, _ = clocks.get(station, (None, None))
            late = clock is not None and start + timedelta(minutes=window) <= clock - lateness
            if not late:
                entry, net = open_windows.get((station, start), (0 if baseline == "zero" else value, 0))
                open_windows[station, start] = value, net + abs(value - entry)
            out.append((station, seq, value, None if late else open_windows[station, start][1], late))
            times[station] = max(ts, times.get(station, ts))
        for station, now in times.items():
            clock, reached = clocks.get(station, (None, None))
            both = min(reached, now) if reached is not None else None
            clocks[station] = max((x for x in (clock, both) if x is not None), default=None), now
        for station, start in list(open_windows):
            clock = clocks[station][0]
            if clock is not None and start + timedelta(minutes=window) <= clock - lateness:
                del open_windows[station, start]
    return sorted(out, key=repr)


@pytest.mark.parametrize("baseline", ["zero", "first"])
@pytest.mark.parametrize("buckets", [1, 1024])
def test_stations_of_one_bucket_keep_their_own_clocks(spark, rows, tmp_path, monkeypatch, baseline, buckets):
    monkeypatch.setattr(keyed, "BUCKETS", buckets)
    rng = random.Random(buckets)
    batches = [[(None if rng.random() < 0.02 else f"s{rng.randint(0, 8)}",
                 at("2024-01-01") + timedelta(minutes=60 * b * rng.randint(0, 3) + rng.randint(0, 90)),
                 b * 200 + q, None if rng.random() < 0.05 else rng.randint(0, 20)) for q in range(200)]
               for b in range(4)]
    stream = stream_of(spark, str(tmp_path / "in"), READINGS, *batches)
    got = taken(spark, keyed.net_delta_updates(stream, "15 minutes", baseline, timedelta(minutes=30)), tmp_path)
    want = plain_totals(batches, 15, timedelta(minutes=30), baseline)
    assert any(r[-1] for r in want)
    assert rows(got, "station_id", "seq", "num_bikes_available", "net", "late") == want


def test_a_station_is_read_and_written_once_a_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(6000).selectExpr(
        "cast(id % 600 as string) station_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id div 600) ts",
        "id seq", "3 num_bikes_available").coalesce(1).write.parquet(path)
    done = run.run_available(keyed.net_delta_updates(spark.readStream.schema(READINGS).parquet(path)),
                             lambda df, n: df.write.format("noop").mode("append").save(), str(tmp_path / "checkpoint"))
    # Ten windows and a clock, but one record.
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in done.recentProgress if p["stateOperators"]) == 600


def test_rows_that_are_dealt_are_made_once(spark, tmp_path, monkeypatch):
    from checks import queries, stream_queries
    path, made = str(tmp_path), spark.sparkContext.accumulator(0)
    spark.range(90).selectExpr(
        "id event_id", "to_timestamp_ntz('2024-01-20') ts", "id % 3 user_id", "'view' event_type", "100D - id value",
        "'{}' props").write.parquet(f"{path}/events.parquet")

    def counted(seq):
        made.add(1)
        return seq

    real, count = stream_queries.train_plan.arrivals, F.udf(counted, "long").asNondeterministic()
    monkeypatch.setattr(stream_queries.train_plan, "arrivals", lambda topic: real(topic).withColumn("seq", count("seq")))
    got = queries.all_queries()["stream_keyed_improvements"](spark, path)
    assert got.count() > 5 and made.value == 90
