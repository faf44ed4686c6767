"""Streams of several micro-batches end in the rows of the batch forms."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom import schemas
from feedloom.operators import stations, tables, transit
from feedloom.plans import bikeshare
from feedloom.plans import trains as train_plan
from feedloom.sinks import writers
from feedloom.sources import files, topics
from feedloom.streaming import folds, run, streams


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """A status topic as five files, in arrival order."""
    rng = random.Random(4)
    path = str(tmp_path_factory.mktemp("topic"))
    rows = []
    for q in range(400):
        ts = at(f"2024-01-{1 + q // 100:02d} {q % 100 // 10:02d}:{q % 10:02d}:00")
        station = "hot" if rng.random() < 0.4 else rng.choice("abc")
        rows.append((station, f'{{"num_bikes_available":{rng.randint(0, 20)}}}', ts, q))
    schema = "key string, value string, timestamp timestamp, offset bigint"
    for i in range(0, 400, 80):
        spark.createDataFrame(rows[i:i + 80], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def _run(spark, df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    run.run_available(df, writers.files(out), str(tmp_path / "checkpoint"), mode)
    return spark.read.parquet(out)


def _fold(spark, stream, tmp_path, writer):
    """What a fold wrote; ``writer`` takes its state's path and the sink."""
    out = str(tmp_path / "out")
    run.run_available(stream, writer(str(tmp_path / "state"), writers.files(out)), str(tmp_path / "checkpoint"))
    return spark.read.parquet(out)


@pytest.mark.parametrize("baseline", ["zero", "first"])
def test_net_delta(spark, rows, feed, tmp_path, baseline):
    stream = stations.decode_status(topics.topic_files(spark, feed, stream=True, max_files=1))
    batch = stations.decode_status(topics.topic_files(spark, feed))
    updates = _fold(spark, stream, tmp_path, lambda state, write: folds.net_delta_writer(
        state, write, "60 minutes", baseline))
    assert updates.select(writers.BATCH).distinct().count() >= 5
    changelog = stations.net_delta_changelog(batch, "60 minutes", baseline)
    columns = ["station_id", "window_start", "seq", "num_bikes_available", "net"]
    assert rows(updates, *columns) == rows(changelog, *columns)
    final = tables.latest_per_key(updates, ["station_id", "window_start"], "seq", ["net"])
    assert rows(final) == rows(stations.net_delta(batch, "60 minutes", baseline),
                               "station_id", "window_start", "net")


READINGS = "station_id string, ts timestamp, seq bigint, num_bikes_available int"


def test_late_readings_are_set_aside(spark, rows, tmp_path):
    path = str(tmp_path / "readings")
    for data in ([("a", at("2024-01-01"), 1, 5)], [("a", at("2024-01-09"), 2, 5)],
                 [("a", at("2024-01-09 00:01:00"), 3, 5)], [("a", at("2024-01-01 00:01:00"), 4, 9)]):
        spark.createDataFrame(data, READINGS).coalesce(1).write.mode("append").parquet(path)
    stream = (spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(path))
    late = str(tmp_path / "late")
    got = _fold(spark, stream, tmp_path, lambda state, write: folds.net_delta_writer(
        state, write, lateness="1 day", late=writers.files(late)))
    assert sorted(r.seq for r in got.collect()) == [1, 2, 3]
    assert rows(spark.read.parquet(late), "seq") == [(4,)]


def test_a_replayed_batch_gives_the_same_state_and_changes(spark, rows, tmp_path):
    seen = []
    write = folds.net_delta_writer(str(tmp_path), lambda df, n: seen.append(rows(df, "seq", "net")))
    def readings(*data):
        return spark.createDataFrame([("a", at("2024-01-01"), q, v) for q, v in data], READINGS)
    write(readings((1, 5)), 0)
    write(readings((2, 9)), 1)
    write(readings((2, 9)), 1)
    write(readings(), 2)
    write(readings((3, 0)), 3)
    assert seen == [[(1, 5)], [(2, 9)], [(2, 9)], [], [(3, 18)]]


def test_improvements_and_next_arrival(spark, rows, tmp_path):
    rng = random.Random(8)
    path = str(tmp_path / "trips")
    schema = "key string, value string, timestamp timestamp, offset bigint"
    data = []
    for q in range(300):
        stop = rng.choice(["101N", "101S", "102N"])
        data.append((None, f'{{"trip":{{"routeId":"1"}},"stopTimeUpdate":[{{"stopId":"{stop}",'
                           f'"arrival":{{"time":"{3000 - q * 3 + rng.randint(0, 800)}"}}}}]}}',
                     at("2024-01-01"), q))
    for i in range(0, 300, 75):
        spark.createDataFrame(data[i:i + 75], schema).coalesce(1).write.mode("append").parquet(path)
    now = F.lit(2200)
    stream = train_plan.arrivals(topics.topic_files(spark, path, stream=True, max_files=1))
    batch = train_plan.arrivals(topics.topic_files(spark, path))
    better = _fold(spark, stream, tmp_path / "a", lambda state, write: folds.improvements_writer(
        state, write, lambda: F.lit(2200)))
    want = transit.arrival_improvements(batch, now)
    assert rows(better, *want.columns) == rows(want)
    assert want.count() > 5
    nearest = _fold(spark, stream, tmp_path / "b", lambda state, write: folds.next_arrival_writer(
        state, write, lambda: F.lit(2200)))
    last = nearest.where(F.col(writers.BATCH) == nearest.agg(F.max(writers.BATCH)).scalar())
    assert rows(last, *transit.TRACK, "arrival") == rows(transit.next_arrival(batch, now), *transit.TRACK, "arrival")


def test_a_train_that_has_passed_gives_way_to_the_next(spark, rows, tmp_path):
    """The clock moves between micro-batches, and between two runs from one checkpoint."""
    path, out, state = (str(tmp_path / n) for n in ("arrivals", "out", "state"))
    schema = "seq bigint, route_id string, stop_id string, direction string, arrival bigint"
    clock = iter([100, 110, 150])

    def send(*times):
        spark.createDataFrame([(t, "1", "101", "N", t) for t in times], schema).coalesce(1).write.mode(
            "append").parquet(path)

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        run.run_available(stream, folds.next_arrival_writer(
            state, writers.files(out), lambda: F.lit(next(clock))), str(tmp_path / "checkpoint"))

    send(125, 4000)
    send(7000)
    go()
    send(4100)
    go()
    assert rows(spark.read.parquet(out), writers.BATCH, "arrival", "total_minutes") == [
        (0, 125, 0), (1, 125, 0), (2, 4000, 64)]


def test_lookup_sees_information_written_between_batches(spark, rows, feed, tmp_path):
    out, seen = str(tmp_path / "out"), []

    def read_info():
        seen.append(1)
        capacity = 100 if len(seen) == 1 else 1
        return spark.createDataFrame([("hot", capacity)], "station_id string, capacity int")

    stream = stations.decode_status(topics.topic_files(spark, feed, stream=True, max_files=1))
    run.run_available(stream, streams.refreshed_lookup(read_info, writers.files(out)),
                      str(tmp_path / "checkpoint"))
    got = spark.read.parquet(out)
    assert got.where("capacity = 100").count() > 0
    # Later batches saw the new capacity: only empty docks fall below the threshold.
    assert got.where("capacity = 1 and num_bikes_available > 0").count() == 0
    assert got.where("capacity = 1").count() > 0


def test_a_query_resumes_from_its_checkpoint(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):
        stream = stations.decode_status(topics.topic_files(spark, feed, stream=True))
        run.run_available(stream, writers.files(out), checkpoint)
    assert spark.read.parquet(out).count() == 400


def test_stateless_plan_runs_on_streams(spark, rows, feed, tmp_path):
    info = spark.createDataFrame([(s, f'{{"capacity":{c}}}', at("2024-01-01"), i) for i, (s, c) in
                                  enumerate([("hot", 30), ("a", 0)])],
                                 "key string, value string, timestamp timestamp, offset bigint")
    stream = bikeshare.low_availability(topics.topic_files(spark, feed, stream=True), info)
    got = _run(spark, stream, tmp_path)
    assert rows(got, "key", "value") == rows(
        bikeshare.low_availability(topics.topic_files(spark, feed), info), "key", "value")


def test_top_turnover_of_a_stream(spark, rows, feed, tmp_path):
    info = spark.createDataFrame([("hot", 30), ("a", 10), ("b", 50), ("c", 0)],
                                 "station_id string, capacity int")
    stream = stations.decode_status(topics.topic_files(spark, feed, stream=True, max_files=1))
    ranked = _fold(spark, stream, tmp_path, lambda state, write: folds.top_turnover_writer(
        state, lambda: info, write, n=2))
    # The last ranking of a window is the one of the batch form.
    last = ranked.groupBy("window_start").agg(F.max(writers.BATCH).alias(writers.BATCH))
    final = ranked.join(last, ["window_start", writers.BATCH])
    batch = stations.decode_status(topics.topic_files(spark, feed))
    want = stations.top_turnover(stations.turnover_ratio(stations.net_delta(batch), info), 2)
    columns = ["window_start", "rank", "station_id", "turnover"]
    assert rows(final, *columns) == rows(want, *columns)


def test_station_counts_are_observed(spark, tmp_path):
    feed = spark.createDataFrame([(1, ([("a", 1), ("b", 2)],))],
                                 "ttl int, data struct<stations:array<struct<station_id:string,n:int>>>")
    path = str(tmp_path / "feed")
    feed.write.json(path)
    stream = spark.readStream.schema(feed.schema).json(path)
    query = run.run_available(stations.observe_count(stations.flatten_feed(stream)),
                              writers.files(str(tmp_path / "out")), str(tmp_path / "c"))
    metrics = [p.observedMetrics["feed"].stations for p in query.recentProgress
               if "feed" in (p.observedMetrics or {})]
    assert sum(metrics) == 2


def test_snapshot_files_stream(spark, rows, tmp_path):
    (tmp_path / "feed").mkdir()
    for i in (1, 2):
        (tmp_path / "feed" / f"{i}.json").write_text(
            '{"ttl": 10,\n "data": {"stations": [\n{"station_id": "%d", "num_bikes_available": 3}]}}' % i)
    stream = bikeshare.publish_status(files.status_feed(spark, str(tmp_path / "feed"), stream=True))
    assert rows(_run(spark, stream, tmp_path), "key") == [("1",), ("2",)]


def test_broken_snapshot_files_are_set_aside(spark, rows, tmp_path):
    (tmp_path / "1.json").write_text('{"ttl": 10,\n "data": {"stations": [{"station_id": "1"}]}}')
    (tmp_path / "2.json").write_text('{"ttl": 10,\n "data')
    assert rows(stations.flatten_feed(files.status_feed(spark, str(tmp_path))), "station_id") == [("1",)]
    bad = files.corrupt_snapshots(spark, str(tmp_path), schemas.STATUS_FEED)
    assert rows(bad) == [('{"ttl": 10,\n "data',)]


def test_turnover_messages_of_a_stream(spark, rows, feed, tmp_path):
    info = spark.createDataFrame([("hot", 30), ("c", 0)], "station_id string, capacity int")
    stream = stations.decode_status(topics.topic_files(spark, feed, stream=True, max_files=2))
    got = _fold(spark, stream, tmp_path, lambda state, write: bikeshare.turnover_updates(state, lambda: info, write))
    changelog = stations.net_delta_changelog(stations.decode_status(topics.topic_files(spark, feed)))
    want = stations.turnover_lines(stations.turnover_ratio(changelog, info))
    assert rows(got, "key", "value") == rows(want, "key", "value")
    assert want.where("value like '%NA%%'").count() > 0


def test_countdown_messages_of_a_stream(spark, rows, tmp_path):
    path = str(tmp_path / "trips")
    data = [(None, f'{{"trip":{{"routeId":"1"}},"stopTimeUpdate":[{{"stopId":"101N",'
                   f'"arrival":{{"time":"{t}"}}}}]}}', at("2024-01-01"), q)
            for q, t in enumerate([900, 800, 850, 700, 90])]
    schema = "key string, value string, timestamp timestamp, offset bigint"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(path)
    stops = spark.createDataFrame([("101", "Elm")], "stop_id string, stop_name string")
    stream = train_plan.arrivals(topics.topic_files(spark, path, stream=True))
    got = _fold(spark, stream, tmp_path, lambda state, write: train_plan.countdown_updates(
        state, stops, lambda: F.lit(100), write))
    want = train_plan.countdown(topics.topic_files(spark, path), stops, F.lit(100))
    assert rows(got, "seq", "message") == rows(want, "seq", "message")
    assert [r[0] for r in rows(want, "seq")] == [0, 1, 3]


TOPIC = "key string, value string, timestamp timestamp, partition int, offset bigint"


def _partitioned(rng, n):
    """Un-keyed records of three partitions of different speed, in order of their arrival."""
    offsets, data = [0, 1000, 7], []
    for i in range(n):
        p = rng.choice([0, 0, 0, 1, 2])
        offsets[p] += rng.randint(1, 3)
        data.append((None, f'{{"trip":{{"routeId":"1"}},"stopTimeUpdate":[{{"stopId":"{rng.choice(["101N", "102S"])}",'
                           f'"arrival":{{"time":"{5000 - 4 * i + rng.randint(0, 900)}"}}}}]}}',
                     at(f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00"), p, offsets[p]))
    return data


def _plain_improvements(data, now):
    import json
    best, out = {}, []
    for _, value, _, _, offset in data:
        stop = json.loads(value)["stopTimeUpdate"][0]
        arrival, track = int(stop["arrival"]["time"]), stop["stopId"]
        if arrival >= now and arrival < best.get(track, 1 << 62):
            best[track] = arrival
            out.append((arrival, offset, track))
    return sorted(out)


@pytest.mark.parametrize("slices", [None, 1, 4])
def test_improvements_over_partitions_of_a_topic(spark, slices):
    from feedloom.operators import skew
    data = _partitioned(random.Random(2), 300)
    topic = topics.text_rows(spark.createDataFrame(random.Random(1).sample(data, len(data)), TOPIC))
    arrivals = train_plan.arrivals(topic)
    hot = None if slices is None else skew.hot_keys(arrivals, transit.TRACK, transit.ARRIVED, 10, slices)
    got = transit.arrival_improvements(arrivals, F.lit(4100), hot)
    assert sorted((r.arrival, r.seq, r.stop_id + r.direction) for r in got.collect()) == _plain_improvements(data, 4100)


def test_streamed_improvements_over_partitions_of_a_topic(spark, tmp_path):
    data, path = _partitioned(random.Random(4), 240), str(tmp_path / "topic")
    for i in range(0, 240, 80):
        spark.createDataFrame(data[i:i + 80], TOPIC).coalesce(1).write.mode("append").parquet(path)
    stream = train_plan.arrivals(topics.topic_files(spark, path, stream=True, max_files=1))
    got = _fold(spark, stream, tmp_path, lambda state, write: folds.improvements_writer(
        state, write, lambda: F.lit(4100)))
    assert sorted((r.arrival, r.seq, r.stop_id + r.direction) for r in got.collect()) == _plain_improvements(data, 4100)


def test_arrival_numbers_follow_the_order(spark):
    rows = [(None, "", t, p, o) for t in (at("1969-12-31 23:59:59"), at("1970-01-01"), at("2024-01-01"))
            for p in (None, 1, 99_999) for o in (0, 5, 10 ** 17 - 1)]
    df = spark.createDataFrame(rows, TOPIC).select("*", topics.arrival_number().alias("n"))
    got = sorted(df.collect(), key=lambda r: r.n)
    assert [(r.timestamp, r.partition or 0, r.offset) for r in got] == [(t, p or 0, o) for _, _, t, p, o in rows]
    assert len({r.n for r in got}) == len(rows)
    wide = spark.createDataFrame([(None, "", at("2024-01-01"), 100_000, 1)], TOPIC)
    with pytest.raises(Exception, match="too many digits"):
        wide.select(topics.arrival_number()).collect()
    assert spark.createDataFrame([(None, "", None, 1, 1)], TOPIC).select(topics.arrival_number()).first()[0] is None


def _readings(spark, path, *batches):
    for data in batches:
        spark.createDataFrame([(s, at(t), q, n) for s, t, q, n in data], READINGS).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("bad", [[("a", "2100-01-01", 1, 5)], [("a", "2100-01-01", 1, 5), ("b", "2024-01-01", 2, 3)]])
def test_one_record_of_the_far_future_closes_nothing(spark, rows, tmp_path, bad):
    stream = _readings(spark, str(tmp_path / "readings"), bad,
                       [("b", "2024-01-01 00:10:00", 3, 4), ("c", "2024-01-01 00:20:00", 4, 1)],
                       [("a", "2024-01-01 00:30:00", 5, 2), ("a", "2100-01-01 00:01:00", 6, 2), ("c", "2024-01-01 00:40:00", 7, 2)],
                       [("d", "2024-01-02 00:00:00", 8, 2)])
    got = _fold(spark, stream, tmp_path, lambda state, write: folds.net_delta_writer(state, write))
    assert sorted(r.seq for r in got.collect()) == [r[2] for r in bad] + [3, 4, 5, 6, 7, 8]


def test_late_readings_are_kept_without_being_asked_for(spark, rows, tmp_path):
    info = spark.createDataFrame([("a", 10)], "station_id string, capacity int")
    stream = _readings(spark, str(tmp_path / "readings"), [("a", "2024-01-09", 1, 5)], [("a", "2024-01-09 00:01:00", 2, 5)],
                       [("a", "2024-01-01", 3, 7), ("a", "2024-01-09 00:02:00", 4, 6)])
    ranked = _fold(spark, stream, tmp_path, lambda state, write: folds.top_turnover_writer(state, lambda: info, write))
    assert ranked.count() == 3
    assert rows(spark.read.parquet(folds.late_path(str(tmp_path / "state"))), "seq") == [(3,)]


def test_change_totals_by_arrival_number(spark, rows, tmp_path):
    path = str(tmp_path / "readings")
    schema = READINGS.replace("seq bigint", "seq decimal(38,0)")
    for data in ([("a", at("2024-01-01"), 10 ** 30, 5)], [("a", at("2024-01-01"), 10 ** 30 + 2, 1),
                                                          ("a", at("2024-01-01"), 10 ** 30 + 1, 9)]):
        spark.createDataFrame([(s, t, __import__("decimal").Decimal(q), n) for s, t, q, n in data], schema).coalesce(
            1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = _fold(spark, stream, tmp_path, lambda state, write: folds.net_delta_writer(state, write))
    assert rows(got, "num_bikes_available", "net") == [(1, 17), (5, 5), (9, 9)]
