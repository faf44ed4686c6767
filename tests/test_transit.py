import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom import schemas
from feedloom.functions import times, trains
from feedloom.operators import alerts, skew, transit
from feedloom.plans import trains as train_plan
from feedloom.sources import files


def topic(spark, values):
    return spark.createDataFrame([(None, v, at("2024-01-01"), i) for i, v in enumerate(values)],
                                 "key string, value string, timestamp timestamp, offset bigint")


def update(route="1", stops=(("101N", "100"),)):
    return json.dumps({"trip": {"routeId": route}, "stopTimeUpdate": [
        {"stopId": s, "arrival": {"time": t}} for s, t in stops]})


def test_guards(spark, rows):
    values = ["", None, "{broken", "{}", '{"trip": {"routeId": "1"}}',
              '{"trip": {"routeId": "1"}, "stopTimeUpdate": []}',
              '{"stopTimeUpdate": [{"stopId": "101N", "arrival": {"time": "1"}}]}',
              '{"trip": {"routeId": "1"}, "stopTimeUpdate": [{"stopId": "101N"},'
              ' {"arrival": {"time": "5"}}, {"stopId": "102S", "arrival": {"time": "6"}}]}']
    got = train_plan.arrivals(topic(spark, values))
    assert rows(got, "seq", "route_id", "stop_id", "direction", "arrival") == [(7, "1", "102", "S", 6)]


def test_feed_files_to_trip_updates(spark, rows, tmp_path):
    feed = {"header": {"gtfsRealtimeVersion": "1.0", "timestamp": "1500000000",
                       schemas.HEADER_EXTENSION: {"nyctSubwayVersion": "1.0", "tripReplacementPeriod": [
                           {"routeId": "1", "replacementPeriod": {"end": "1500001800"}}]}},
            "entity": [{"id": "1", "tripUpdate": json.loads(update())},
                       {"id": "2", "vehicle": {"stopId": "101N"}},
                       {"id": "3", "alert": {"headerText": {"translation": [{"text": "x"}]}}}]}
    (tmp_path / "feed.json").write_text(json.dumps(feed, indent=1))
    snapshots = files.transit_feed(spark, str(tmp_path))
    entities = transit.feed_entities(snapshots)
    assert rows(entities, "id", "feed_time", "incrementality") == [
        (str(i), 1500000000, "FULL_DATASET") for i in (1, 2, 3)]
    message = transit.trip_update_messages(entities).first()
    assert message["key"] is None
    assert json.loads(message["value"]) == json.loads(update())
    assert rows(transit.replacement_periods(snapshots)) == [("1", None, 1500001800)]
    assert rows(transit.full_dataset(entities), "id") == [("1",), ("2",), ("3",)]


def arrivals(spark, data):
    return spark.createDataFrame(
        data, "seq bigint, route_id string, stop_id string, direction string, arrival bigint")


def test_next_arrival_and_countdown(spark, rows):
    df = arrivals(spark, [(1, "1", "101", "N", 99), (2, "1", "101", "N", 7400), (3, "1", "101", "N", 9000),
                          (4, "1", "101", "S", 100)])
    # Now itself still counts; whole hours are discarded in ``minutes``.
    assert rows(transit.next_arrival(df, F.lit(100)), "direction", "arrival", "minutes",
                "total_minutes") == [("N", 7400, 1, 121), ("S", 100, 0, 0)]


@pytest.mark.parametrize("slices", [None, 9])
def test_improvements_equal_brute_force(spark, rows, slices):
    rng = random.Random(1)
    data, best, want = [], {}, []
    for seq in range(500):
        key = ("1", "101", "N") if rng.random() < 0.7 else (rng.choice("12"), rng.choice("ab"), "S")
        arrival = 2000 - seq + rng.randint(-300, 900)
        data.append((seq, *key, arrival))
        if arrival >= 1000 and arrival < best.get(key, 10 ** 9):
            best[key] = arrival
            want.append((seq, *key, arrival))
    df = arrivals(spark, data)
    hot = skew.hot_keys(df, transit.TRACK, "seq", hot_rows=10, slices=slices) if slices else None
    got = transit.arrival_improvements(df, F.lit(1000), hot)
    assert rows(got) == sorted(want, key=repr)


def test_messages_and_unknown_stops(spark, rows, tmp_path):
    (tmp_path / "stops.csv").write_text("Station ID,GTFS Stop ID,Stop Name\n7,101,Van Cortlandt\n")
    stops = files.stops(spark, str(tmp_path / "stops.csv"))
    df = arrivals(spark, [(1, "1", "101", "N", 400), (2, "1", "999", "N", 400)])
    assert rows(transit.arrival_messages(df, stops, F.lit(100)), "message") == [
        ("Next N bound 1 train will arrive at station Van Cortlandt in 5 minutes",)]
    assert rows(transit.stop_lookup(df, stops), "stop_id", "stop_name") == [
        ("101", "Van Cortlandt"), ("999", None)]
    assert rows(transit.stop_unmatched(df, stops)) == [("999", 1)]
    assert rows(train_plan.countdown(topic(spark, [update()]), stops, F.lit(100)), "message") == [
        ("Next N bound 1 train will arrive at station Van Cortlandt in 0 minutes",)]


def test_feed_merge(spark, rows):
    df = spark.createDataFrame([("a", 1, False, 10), ("a", 2, False, 20), ("b", 1, False, 5),
                                ("b", 3, True, None), ("c", 4, None, 7)],
                               "id string, seq bigint, is_deleted boolean, arrival bigint")
    assert rows(transit.feed_merge(df), "id", "arrival") == [("a", 20), ("c", 7)]


@pytest.mark.parametrize("last, want", [("DIFFERENTIAL", [("a", 30), ("b", 5)]), ("FULL_DATASET", [("a", 30)]),
                                        (None, [("a", 30)])])
def test_a_full_snapshot_replaces_what_it_does_not_name(spark, rows, last, want):
    df = spark.createDataFrame([("a", 1, False, 10, "FULL_DATASET"), ("b", 1, False, 5, "FULL_DATASET"),
                                ("a", 2, False, 30, last)],
                               "id string, seq bigint, is_deleted boolean, arrival bigint, incrementality string")
    assert rows(transit.feed_merge(df), "id", "arrival") == want


PLAN = "trip_id string, stop_sequence bigint, sched bigint, relationship string, delay bigint, time bigint, trip_delay bigint"


def _delays(spark, rows, plan, trip_delay=30):
    """{stop: (relationship, delay, time)} -> {stop: delay in force}"""
    data = [("t", s, s * 1000, *(u or (None, None, None)), trip_delay) for s, u in plan.items()]
    return dict(rows(transit.delay_propagation(spark.createDataFrame(data, PLAN)), "stop_sequence", "effective_delay"))


def test_delay_propagation(spark, rows):
    plan = {1: None, 2: None, 3: ("SCHEDULED", 300, None), 4: None, 5: ("SKIPPED", None, None), 6: None,
            8: ("SCHEDULED", 60, None), 9: None, 10: ("NO_DATA", None, None), 11: None}
    assert _delays(spark, rows, plan) == {
        1: 30, 2: 30, 3: 300, 4: 300, 5: 300, 6: 300, 8: 60, 9: 60, 10: None, 11: None}
    assert set(_delays(spark, rows, {1: None, 2: None}, None).values()) == {None}


def test_a_time_sets_the_delay_and_wins_over_one(spark, rows):
    plan = {1: ("SCHEDULED", None, 1070), 2: None, 3: ("SCHEDULED", 5, 3009), 4: None}
    assert _delays(spark, rows, plan) == {1: 70, 2: 70, 3: 9, 4: 9}


def test_the_trip_delay_lasts_until_a_delay_is_given(spark, rows):
    plan = {1: ("SCHEDULED", None, None), 2: ("NO_DATA", None, None), 3: None, 4: ("SCHEDULED", 60, None),
            5: ("SCHEDULED", None, None), 6: None}
    assert _delays(spark, rows, plan) == {1: 30, 2: 30, 3: 30, 4: 60, 5: None, 6: None}


def test_effective_arrival(spark, rows):
    df = spark.createDataFrame([(100, 200, 5), (100, None, 5), (100, None, None)],
                               "sched bigint, time bigint, delay bigint")
    assert rows(transit.with_effective_arrival(df), "effective_arrival") == [(105,), (200,), (None,)]


def test_trip_completed(spark, rows):
    df = spark.createDataFrame(
        [("done", 1, 10, 0), ("done", 2, 90, None), ("wrong", 1, 90, 30), ("future", 1, 10, 0),
         ("future", 2, 200, 0)], "trip_id string, stop_sequence bigint, time bigint, uncertainty int")
    assert rows(transit.trip_completed(df, F.lit(100)), "trip_id", "completed", "wrong_prediction") == [
        ("done", True, False), ("future", False, False), ("wrong", False, True)]


def test_cancelled_trips(spark, rows):
    plan = spark.createDataFrame([("t1", "1", 50), ("t2", "1", 100), ("t3", "2", 50), ("t4", "1", 60)],
                                 "trip_id string, route_id string, start_s bigint")
    periods = spark.createDataFrame([("1", None, 100)],
                                    "route_id string, period_start bigint, period_end bigint")
    feed = spark.createDataFrame([("t4",)], "trip_id string")
    # t2 starts when the period has ended, t3's route has none, t4 runs.
    assert rows(transit.cancelled_trips(plan, periods, feed), "trip_id") == [("t1",)]


def test_reroutes_and_assignment(spark, rows):
    df = spark.createDataFrame([("a", 1, "1", "2"), ("a", 2, "1", None), ("b", 1, "1", "1")],
                               "trip_id string, stop_sequence int, scheduled_track string, actual_track string")
    assert rows(transit.without_rerouted(df), "trip_id") == [("b",)]
    trips = spark.createDataFrame([("a", True), ("b", False), ("c", None)],
                                  "trip_id string, is_assigned boolean")
    assert rows(transit.assigned_trips(trips), "trip_id") == [("a",)]


def test_service_time_passes_midnight(spark, rows):
    df = spark.createDataFrame([("20240101", "25:15:35"), ("20240101", "00:00:30"), ("bad", "1:2:3")],
                               "d string, t string")
    got = rows(df.select(times.service_time(F.col("d"), F.col("t")).alias("s")))
    assert got == [(1704067230,), (1704067200 + 25 * 3600 + 15 * 60 + 35,), (None,)]


def test_train_ids(spark, rows):
    df = spark.createDataFrame([("06 0123+ PEL/BBR",), ("=1 2359 SFT/242",), ("nonsense",)], "t string")
    got = rows(df.select("t", *trains.train_id_parts(F.col("t"))))
    assert got == [("06 0123+ PEL/BBR", "scheduled", "6", 5010, "PEL", "BBR"),
                   ("=1 2359 SFT/242", "reroute", "1", 86340, "SFT", "242"),
                   ("nonsense", None, None, None, None, None)]


def test_alert_periods(spark, rows):
    df = spark.createDataFrame(
        [(1, [(None, None)]), (2, []), (3, None), (4, [(100, None)]), (5, [(None, 100)]),
         (6, [(0, 10), (90, 110)]), (7, [(101, None)])],
        "id int, active_period array<struct<start:bigint,end:bigint>>")
    assert rows(alerts.active_alerts(df, F.lit(100)), "id") == [(1,), (2,), (3,), (4,), (6,)]


def test_alert_selectors_need_every_given_specifier(spark, rows):
    a = spark.createDataFrame([(1, "A", None, None), (2, None, "s1", None), (3, "A", "s1", None),
                               (4, "A", "s2", None), (5, None, None, None), (6, "A", "s1", "bus")],
                              "id bigint, route_id string, stop_id string, kind string")
    t = spark.createDataFrame([("A", "s1", "rail"), ("B", "s1", "rail"), ("C", "s9", "rail"), (None, "s1", None)],
                              "route_id string, stop_id string, kind string")
    got = alerts.alert_targets(a, t, ["route_id", "stop_id", "kind"])
    assert rows(got, "route_id", "alerts", "last_id") == [("A", 3, 3), ("B", 1, 2), (None, 1, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_an_alert_with_several_selectors_counts_once(spark, rows):
    feed = [("1", [("A", None), (None, "101")]), ("2", [("A", None), ("A", None)]), ("3", [("B", "101"), ("A", "102")])]
    entities = spark.createDataFrame(
        [(i, ([(None, r, None, None, s) for r, s in chosen],)) for i, chosen in feed],
        "id string, alert struct<informedEntity:array<struct<agencyId:string,routeId:string,routeType:int,"
        "trip:struct<tripId:string>,stopId:string>>>")
    a = alerts.informed_entities(entities)
    t = spark.createDataFrame([("A", "101"), ("A", "102"), ("B", "101"), ("C", "9")], "route_id string, stop_id string")
    assert rows(alerts.alert_targets(a, t, ["route_id", "stop_id"]), "route_id", "stop_id", "alerts", "last_id") == [
        ("A", "101", 2, "2"), ("A", "102", 3, "3"), ("B", "101", 2, "3")]


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_alerts_of_many_selectors_against_every_pair(spark, rows, size):
    rng, names = random.Random(size), [f"s{i}" for i in range(size)]
    given = [(rng.choice([None, *range(60)]), *[rng.choice([None, None, "x", "y", "z"]) for _ in names])
             for _ in range(300)]
    targets = {tuple(rng.choice([None, "x", "y", "z", "w"]) for _ in names) for _ in range(40)}
    by_id = Counter(i for i, *_ in {g for g in given if any(g[1:])})
    want = []
    for t in targets:
        # Alerts without an id are one, and counted only if it has one selector.
        found = {i for i, *s in given if any(s) and all(x is None or x == y for x, y in zip(s, t))
                 and (i is not None or by_id[None] == 1)}
        if found:
            want.append((*t, len(found), max(i for i in found if i is not None)))
    kinds = ", ".join(f"{n} string" for n in names)
    got = alerts.alert_targets(spark.createDataFrame(given, f"id int, {kinds}"),
                               spark.createDataFrame(sorted(targets, key=repr), kinds), names)
    assert rows(got) == sorted(want, key=repr)


def test_no_row_per_alert_and_target(spark):
    n = 2000
    many = spark.range(n).selectExpr("id", "'A' route_id", "cast(null as string) stop_id").unionByName(
        spark.range(n).selectExpr("id", "cast(null as string) route_id", "cast(id % 7 as string) stop_id"))
    targets = spark.range(500).selectExpr("'A' route_id", "cast(id as string) stop_id")
    got = alerts.alert_targets(many, targets, ["route_id", "stop_id"])
    assert {(r["alerts"], r["last_id"]) for r in got.collect()} == {(n, n - 1)}
    plan = got._jdf.queryExecution().executedPlan()
    sizes, left = [], [plan.executedPlan() if "Adaptive" in plan.nodeName() else plan]
    while left:
        node = left.pop()
        if node.metrics().contains("numOutputRows"):
            sizes.append(node.metrics().apply("numOutputRows").value())
        below = [node.plan()] if "QueryStage" in node.nodeName() else []
        left += below + [node.children().apply(i) for i in range(node.children().size())]
    assert n <= max(sizes) <= 8 * n


def test_messages_that_are_no_snapshot_are_set_aside(spark, rows):
    sent = spark.createDataFrame([(1, '{"header": {}, "entity": [{"id": "x"}]}'), (2, "{broken"), (3, None)],
                                 "seq int, value string")
    assert rows(transit.feed_entities(transit.decode_feed(sent)), "seq", "id") == [(1, "x")]
    assert rows(transit.malformed_feed(sent)) == [(2, "{broken"), (3, None)]
    updates = topic(spark, [update(), "{broken", ""])
    assert rows(transit.malformed_trip_updates(updates), "offset", "value") == [(1, "{broken")]


def test_translations(spark, rows):
    df = spark.createDataFrame(
        [(1, [("a", "en"), ("b", "fr"), ("c", "fr")]), (2, [("a", None), ("b", "en")]),
         (3, [("a", None), ("b", "de")]), (4, [("b", "de")]), (5, [])],
        "id int, t array<struct<text:string,language:string>>")
    got = df.select("id", trains.pick_translation(F.col("t"), F.lit("fr"), "en"))
    assert rows(got) == [(1, "b"), (2, "b"), (3, "a"), (4, None), (5, None)]


def test_vehicle_status(spark, rows):
    df = spark.createDataFrame([(None, 3), ("STOPPED_AT", 3), ("STOPPED_AT", None)], "s string, n int")
    assert rows(df.select(trains.vehicle_status(F.col("s"), F.col("n")))) == [
        ("IN_TRANSIT_TO",), ("STOPPED_AT",), (None,)]


@pytest.mark.parametrize("slices", [None, 1, 5])
def test_cancelled_trips_by_one_sweep_equal_all_comparisons(spark, rows, slices):
    import random
    rng = random.Random(7)
    pick = lambda lo, hi: rng.choice([None, *[rng.randint(lo, hi) for _ in range(12)]])
    trips = [(i, rng.choice(["A", "A", "B", "C", None]), pick(0, 400)) for i in range(500)]
    periods = [(rng.choice(["A", "A", "A", "B", None]), pick(0, 380), pick(10, 400)) for _ in range(60)] + [("B", None, None)]
    periods = [(r, a, b) for r, a, b in periods if r != "A" or (a is not None and b is not None and b - a < 40)]
    feed = [(i,) for i in range(0, 500, 7)]
    inside = lambda s, a, b: (a is None or (s is not None and a <= s)) and (b is None or (s is not None and s < b))
    want = sorted((t for t in trips if (t[0],) not in set(feed) and t[1] is not None
                   and any(r == t[1] and inside(t[2], a, b) for r, a, b in periods)), key=repr)
    schedule = spark.createDataFrame(trips, "trip_id long, route_id string, start_s long")
    declared = spark.createDataFrame(periods, "route_id string, period_start long, period_end long")
    hot = None if slices is None else skew.hot_keys(schedule, ["route_id"], "start_s", 50, slices)
    got = transit.cancelled_trips(schedule, declared, spark.createDataFrame(feed, "trip_id long"), hot)
    assert got.columns == schedule.columns and rows(got) == want
    assert 50 < len(want) < 400
