import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom import schemas
from feedloom.functions.tags import tag_regex
from feedloom.operators import logs
from feedloom.plans import log_shipping
from feedloom.sinks import writers
from feedloom.sources import files
from feedloom.streaming import run


@pytest.mark.parametrize("pattern,tag,matches", [
    ("*.**", "httpd.access", True), ("*.**", "httpd", True), ("*.**", "a.b.c", True), ("*.**", "", False),
    ("a.*", "a.b", True), ("a.*", "a.b.c", False), ("a.*", "a", False), ("a.**", "a", True),
    ("a.**", "a.b.c", True), ("a.**", "ab", False), ("**", "x.y", True), ("**.z", "z", True),
    ("**.z", "x.y.z", True), ("{a,b}.c", "b.c", True), ("{a,b}.c", "d.c", False),
    ("a.b x.*", "x.q", True), ("a.b", "axb", False)])
def test_tag_patterns(spark, pattern, tag, matches):
    df = spark.createDataFrame([(tag,)], "tag string")
    assert df.select(F.col("tag").rlike(tag_regex(pattern))).first()[0] is matches


def records(spark, *data):
    return spark.createDataFrame([(i, tag, at(ts), rec) for i, (tag, ts, rec) in enumerate(data)],
                                 "seq bigint, tag string, ts timestamp, record string")


SOME = [("httpd.access", "2024-03-05 01:59:59", '{"a":1}'),
        ("httpd.access", "2024-03-05 13:00:00", '{"a":2}'),
        ("app.error", "2024-11-25 23:00:00", '{"a":3}'), ("app.error", "2024-11-25 23:30:00", "{broken")]


def test_first_matching_route_wins(spark, rows):
    routed = logs.route_tags(records(spark, *SOME), [("app.*", "errors"), ("httpd.*", "web"), ("*.**", "x")])
    assert rows(routed, "topic") == [("errors",), ("errors",), ("web",), ("web",)]
    assert logs.route_tags(records(spark, *SOME), [("app.*", "errors")]).count() == 2
    messages = log_shipping.collect(records(spark, *SOME))
    assert messages.columns == ["key", "value", "topic"]
    assert messages.where("key is not null or topic <> 'log-messages'").count() == 0


def test_objects_lie_below_time_paths_of_a_24_hour_clock(spark, rows, tmp_path):
    path = str(tmp_path / "objects")
    write = writers.time_partitioned_json(path, rotate=1)
    write(records(spark, *SOME), 0)
    write(records(spark, *SOME), 0)
    write(records(spark, SOME[0]), 1)
    dirs = {os.path.relpath(os.path.dirname(f), path).rsplit("/", 1)[0]
            for f in glob.glob(path + "/**/*.json", recursive=True)}
    assert dirs == {"year=2024/month=3/day=5/hour=1", "year=2024/month=3/day=5/hour=13",
                    "year=2024/month=11/day=25/hour=23"}
    got = spark.read.json(path)
    assert rows(got.groupBy("hour").count()) == [(1, 2), (13, 1), (23, 2)]
    # One record an object: two objects in the hour of the two records.
    assert len(glob.glob(path + "/year=2024/month=11/day=25/hour=23/*/*.json")) == 2
    pruned = got.where("year = 2024 and hour = 13")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned


def test_partition_counts(spark, rows):
    assert rows(logs.partition_counts(records(spark, *SOME), rotate=1), "hour", "records", "objects") == [
        ("1", 1, 1), ("13", 1, 1), ("23", 2, 2)]


def test_documents_have_repeatable_ids(spark, rows):
    docs = logs.index_documents(records(spark, *SOME), "log-messages", 2)
    assert rows(docs, "doc_id", "source") == [
        ("log-messages+2+0", '{"a":1}'), ("log-messages+2+1", '{"a":2}'),
        ("log-messages+2+2", '{"a":3}'), ("log-messages+2+3", '{"message":"{broken"}')]
    parts = records(spark, SOME[0], SOME[1]).withColumn("partition", F.col("seq") % 2).withColumn("seq", F.lit(0))
    assert rows(logs.index_documents(parts), "doc_id") == [("log-messages+0+0",), ("log-messages+1+0",)]


def test_one_stream_to_three_sinks(spark, capfd, tmp_path):
    source = str(tmp_path / "logs")
    records(spark, *SOME).drop("seq").write.json(source)
    stream = files.logs(spark, source, stream=True).withColumn("seq", F.lit(1).cast("bigint"))
    assert files.logs(spark, source).schema == schemas.LOG_RECORD
    objects, docs = str(tmp_path / "objects"), str(tmp_path / "docs")
    run.run_available(stream, log_shipping.ship(objects, docs, show=True), str(tmp_path / "c"))
    assert spark.read.json(objects).count() == 4
    assert spark.read.json(docs).count() == 4
    shown = [json.loads(x) for x in capfd.readouterr().out.splitlines() if x.startswith('{"tag"')]
    assert len(shown) == 4


def test_every_sink_is_a_query_of_its_own(spark, tmp_path):
    source = str(tmp_path / "logs")
    records(spark, *SOME).drop("seq").write.json(source)
    stream = files.logs(spark, source, stream=True).withColumn("seq", F.lit(1).cast("bigint"))

    def fails(df, batch_id):
        raise RuntimeError("this sink is down")

    sinks = {**log_shipping.targets(str(tmp_path / "objects"), str(tmp_path / "docs")), "documents": fails}
    queries = run.start_each(stream, sinks, str(tmp_path / "c"))
    with pytest.raises(Exception, match="this sink is down"):
        queries["documents"].awaitTermination()
    queries["objects"].awaitTermination()
    queries["console"].awaitTermination()
    assert spark.read.json(str(tmp_path / "objects")).count() == 4


def test_the_console_prints_every_row_whole(spark):
    lines = []
    writers.console(lines.append)(spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("text")), 0)
    assert len(lines) == 100 and all(len(json.loads(x)["text"]) == 50 for x in lines)


def test_lines_that_are_no_records_are_set_aside(spark, rows, tmp_path):
    (tmp_path / "log").write_text('{"tag":"a.b","ts":"2024-01-01T00:00:00","record":"{}"}\n{broken\n')
    assert rows(files.logs(spark, str(tmp_path / "log")), "tag") == [("a.b",)]
    assert rows(files.corrupt_lines(spark, str(tmp_path / "log"), schemas.LOG_RECORD)) == [("{broken",)]


def test_native_object_stream_and_gzip(spark, tmp_path):
    source = str(tmp_path / "logs")
    records(spark, *SOME).drop("seq").write.json(source)
    path = str(tmp_path / "objects")
    query = run.to_time_partitioned_json(files.logs(spark, source, stream=True), path,
                                         str(tmp_path / "c"), every="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert spark.read.json(path).where("hour = 23").count() == 2
    writers.json_lines(str(tmp_path / "gz"))(records(spark, *SOME), 0)
    assert glob.glob(str(tmp_path / "gz" / "*" / "*.json.gz"))
    query = run.to_console(files.logs(spark, source, stream=True), str(tmp_path / "c2"), every="0 seconds")
    query.processAllAvailable()
    query.stop()


def test_routed_writer_and_text(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "topic string, value string")
    writers.routed("topic", {t: writers.text(str(tmp_path / t)) for t in "ab"})(df, 0)
    assert rows(spark.read.text(str(tmp_path / "b")), "value") == [("2",)]


def test_kafka_settings():
    options = writers.kafka_options("h:9092", "t", "gzip")
    assert options["kafka.acks"] == "all" and options["kafka.compression.type"] == "gzip"
    assert (run.POLL, run.FLUSH, run.ROTATE) == ("30 seconds", "3 seconds", "60 seconds")


def test_routes_by_index_are_the_routes(spark):
    rng = random.Random(5)
    parts = ["a", "b", "ab", "", "*", "**", "a*", "**b", "b**", "{a,b}", "{a.b,**}", "x{a,b.a}"]
    routes = [(" ".join(".".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 2))), f"t{i}")
              for i in range(60)]
    names = [".".join(rng.choices(["a", "b", "ab", "ba", "xa", "c", ""], k=rng.randint(1, 5))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*names, None, "", "a", "a", "x.y.z"])], "seq long, tag string")
    for some in (routes, routes[:5], [*routes[7:20], ("a", None)]):
        want = logs.route_tags(df, some).select("seq", "topic").orderBy("seq").collect()
        got = logs.route_tags_by_index(df.withColumn("topic", F.lit("own")), logs.route_index(spark, some))
        assert got.select("seq", "topic").orderBy("seq").collect() == want
    assert logs.route_tags_by_index(df.limit(0), logs.route_index(spark, routes)).collect() == []
    assert logs.route_tags_by_index(df, logs.route_index(spark, [])).collect() == []


def test_the_plan_does_not_grow_with_the_routes(spark):
    df = spark.range(20_000).select(F.concat(F.lit("app."), F.col("id").cast("string"), F.lit(".error")).alias("tag"))
    sizes = []
    for n in (10, 10_000):
        routes = [(f"app.{i}.**", f"topic{i % 7}") for i in range(n)]
        routed = logs.route_tags_by_index(df, logs.route_index(spark, routes))
        plan = routed._jdf.queryExecution().optimizedPlan().toString().splitlines()
        sizes.append(len(plan))
        assert routed.where(F.col("topic") == "topic3").count() == sum(i % 7 == 3 for i in range(n))
    assert sizes[0] == sizes[1]
