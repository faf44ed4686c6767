import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom.operators import landing, posts
from feedloom.plans import publishing
from feedloom.sinks import landing as landing_sink
from feedloom.sinks import writers
from feedloom.sources import files, tables
from feedloom.streaming import run


def forms(spark, *data):
    return spark.createDataFrame(
        list(data), "seq bigint, title string, body string, date string, author string, action string")


DRAFT = (1, "A draft title", "A draft body", "2018-07-01", "someone", "draft")
FINAL = (2, "A final title", "A final body", "2018-07-01", "someone", "save")


def test_a_draft_goes_to_entries_and_nowhere_else(spark, rows, tmp_path):
    entries, table = str(tmp_path / "entries"), str(tmp_path / "table")
    publishing.save_forms(entries, table)(forms(spark, DRAFT), 0)
    assert rows(writers.read_entries(spark, entries, "title", "body")) == [
        ("A draft title", "A draft body")]
    assert tables.posts_table(spark, table).count() == 0


def test_a_saved_post_gives_exactly_one_row(spark, rows, tmp_path):
    entries, table = str(tmp_path / "entries"), str(tmp_path / "table")
    publishing.save_forms(entries, table)(forms(spark, FINAL), 0)
    assert rows(tables.posts_table(spark, table), "title", "body", "date", "author") == [
        ("A final title", "A final body", at("2018-07-01"), "someone")]
    assert spark.read.parquet(entries).count() == 0


def test_replayed_batch_changes_nothing_and_last_write_wins(spark, rows, tmp_path):
    entries, table = str(tmp_path / "entries"), str(tmp_path / "table")
    write = publishing.save_forms(entries, table)
    write(forms(spark, DRAFT, FINAL), 0)
    write(forms(spark, DRAFT, FINAL), 0)
    later = (9, "A draft title", "Rewritten", "2018-07-02", "someone", "draft")
    write(forms(spark, later, (3, "A draft title", "Older", None, "someone", "draft")), 1)
    assert rows(writers.read_entries(spark, entries, "title", "body")) == [
        ("A draft title", "Rewritten")]
    assert tables.posts_table(spark, table).count() == 1


@pytest.mark.parametrize("title,date,author,reason", [
    ("t", "2018-07-01", "a", None), ("t", "2018-7-1", "a", None), ("t", None, "a", None),
    ("", "2018-07-01", "a", "title"), (None, "2018-07-01", "a", "title"), ("t", "2018-07-01", " ", "author"),
    ("t", "2018/07/01", "a", "date"), ("t", "2018-13-01", "a", "date"), ("t", "2018-02-30", "a", "date"),
    ("t", "", "a", "date"), ("t", "18-07-01", "a", "date")])
def test_validation(spark, title, date, author, reason):
    df = forms(spark, (1, title, "b", date, author, "save"))
    assert posts.validate_posts(df).first()["reason"] == reason


def test_any_other_action_goes_to_the_table(spark, rows):
    df = forms(spark, (1, "t", "b", None, "a", None), (2, "t", "b", None, "a", "publish"))
    assert rows(posts.route_posts(df), "seq", "route") == [(1, "table"), (2, "table")]


def snapshot(spark, *ids):
    return spark.createDataFrame([(i, 1, f"t{i}", f"b{i}") for i in ids],
                                 "id int, userId int, title string, body string")


def test_only_announced_snapshots_load(spark, rows, tmp_path):
    path, manifest = str(tmp_path / "landing"), str(tmp_path / "manifest")
    target = publishing.import_snapshot(snapshot(spark, 1, 2), path, manifest, datetime(2018, 7, 1, 12))
    assert target.endswith("ingest_ts=20180701120000")
    landing_sink.land_snapshot(snapshot(spark, 3), path, "20180702120000")
    # A message without a path is ignored.
    landing_sink.notify(spark.createDataFrame([(None,)], "s3_path string"), manifest)
    loaded = publishing.load_announced(files.manifest(spark, manifest))
    assert rows(loaded, "id", "title", "ingest_ts") == [
        (1, "t1", "20180701120000"), (2, "t2", "20180701120000")]
    # Announced twice, loaded once.
    landing_sink.notify(spark.createDataFrame([(target,)], "s3_path string"), manifest)
    assert publishing.load_announced(files.manifest(spark, manifest)).count() == 2


def test_announced_runs_prune_the_landing_table(spark, rows, tmp_path):
    path, manifest = str(tmp_path / "landing"), str(tmp_path / "manifest")
    landed = snapshot(spark, 1, 2, 3, 4).withColumn("ingest_ts", F.concat(F.lit("2018070"), "id"))
    landing_sink.land_runs(landed, path)

    def announce(*paths):
        landing_sink.notify(spark.createDataFrame([(p,) for p in paths], "s3_path string"), manifest)

    announce(f"{path}/ingest_ts=20180701", f"{path}/ingest_ts=20180703/", f"{path}/ingest_ts=20180701", "")
    notices = files.manifest(spark, manifest)
    loaded = publishing.load_landed(notices, path)
    assert rows(loaded, "id", "title", "ingest_ts") == [(1, "t1", "20180701"), (3, "t3", "20180703")]
    # Read directories are chosen when the query runs, and the plan has one read of the table.
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(ingest_ts" in plan and plan.count("FileScan json [id") <= 2
    assert publishing.not_landed(notices, path).collect() == []
    announce(f"{path}/ingest_ts=20180799", f"{tmp_path}/elsewhere/posts.json", f"{path}/ingest_ts=20180702/part.json")
    lost = publishing.not_landed(files.manifest(spark, manifest), path)
    assert rows(lost) == sorted([(f"{path}/ingest_ts=20180799",), (f"{tmp_path}/elsewhere/posts.json",),
                                 (f"{path}/ingest_ts=20180702/part.json",)])
    with pytest.raises(ValueError, match="not landed"):
        publishing.load_on_notification(lambda df, n: None, landing_path=path)(files.manifest(spark, manifest), 0)
    # A run landed again replaces itself and no other.
    landing_sink.land_runs(landed.where("id = 1").withColumn("title", F.lit("new")), path)
    assert rows(publishing.load_landed(notices, path), "id", "title") == [(1, "new"), (3, "t3")]


def test_stream_of_notifications_of_one_landing_table(spark, rows, tmp_path):
    path, manifest, out = (str(tmp_path / n) for n in ("landing", "manifest", "out"))
    for day, ids in ((1, (1, 2)), (2, (3,))):
        publishing.import_snapshot(snapshot(spark, *ids), path, manifest, datetime(2018, 7, day))
    landing_sink.land_snapshot(snapshot(spark, 9), path, "20180709000000")
    run.run_available(files.manifest(spark, manifest, stream=True),
                      publishing.load_on_notification(writers.files(out), landing_path=path),
                      str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_announced_objects_may_have_any_name(spark, rows, tmp_path):
    bucket = tmp_path / "bucket"
    bucket.mkdir()
    (bucket / "posts_20180701120000.json").write_text(json.dumps(
        [{"id": 1, "userId": 2, "title": "t", "body": "line\nbreak"}, {"id": 2, "userId": 2, "title": "u", "body": "b"}]))
    (bucket / "posts_20180702120000.json").write_text(json.dumps([{"id": 3}]))
    (bucket / "posts_20180703120000.json").write_text("[{broken")
    def notices(*names):
        return spark.createDataFrame([(f"{bucket}/{n}",) for n in names] + [("",)], "s3_path string")
    got = publishing.load_announced(notices("posts_20180701120000.json"))
    assert rows(got, "id", "body", "ingest_ts") == [(1, "line\nbreak", None), (2, "b", None)]
    bad, good = [], []
    write = publishing.load_on_notification(lambda df, n: good.extend(df.collect()), lambda df, n: bad.extend(df.collect()))
    write(notices("posts_20180701120000.json", "posts_20180703120000.json"), 0)
    assert sorted(r["id"] for r in good) == [1, 2] and [r["value"] for r in bad] == ["[{broken"]
    with pytest.raises(ValueError):
        publishing.load_on_notification(lambda df, n: None)(notices("posts_20180703120000.json"), 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publishing.load_announced(notices("gone.json")).collect()
    assert publishing.load_announced(notices()).collect() == []


def test_broken_lines_are_set_aside(spark, rows, tmp_path):
    run_dir = tmp_path / "landing" / "ingest_ts=1"
    run_dir.mkdir(parents=True)
    (run_dir / "part.json").write_text('{"id": 1, "title": "t"}\n{broken\n')
    path = str(tmp_path / "landing")
    assert rows(files.posts(spark, path, multi_line=False), "id", "ingest_ts") == [(1, "1")]
    assert rows(files.corrupt_posts(spark, path, multi_line=False)) == [("1", "{broken")]
    assert files.posts(spark, path, multi_line=False).count() == 1
    assert files.corrupt_posts(spark, path, multi_line=False).count() == 1


def test_json_array_snapshots_as_table_and_stream(spark, rows, tmp_path):
    run_dir = tmp_path / "landing" / "ingest_ts=20180701"
    run_dir.mkdir(parents=True)
    (run_dir / "posts.json").write_text(json.dumps(
        [{"id": 1, "userId": 2, "title": "t", "body": "line\nbreak", "extra": True},
         {"id": 2, "userId": 2, "title": "u", "body": "b"}], indent=1))
    path = str(tmp_path / "landing")
    want = rows(landing.project_posts(files.posts(spark, path)), "id", "userId", "title", "body")
    assert want == [(1, 2, "t", "line\nbreak"), (2, 2, "u", "b")]
    out = str(tmp_path / "out")
    run.run_available(landing.project_posts(files.posts(spark, path, stream=True)),
                      writers.files(out), str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(out), "id", "userId", "title", "body") == want


def test_first_per_id(spark, rows):
    df = snapshot(spark, 1).unionByName(snapshot(spark, 1).withColumn("userId", F.lit(0)))
    assert rows(landing.first_per_id(df), "id", "userId") == [(1, 0)]


def test_stream_of_notifications(spark, rows, tmp_path):
    path, manifest, out = (str(tmp_path / n) for n in ("landing", "manifest", "out"))
    for day, ids in ((1, (1, 2)), (2, (3,))):
        publishing.import_snapshot(snapshot(spark, *ids), path, manifest, datetime(2018, 7, day))
    landing_sink.land_snapshot(snapshot(spark, 9), path, "20180709000000")
    run.run_available(files.manifest(spark, manifest, stream=True),
                      publishing.load_on_notification(writers.files(out)),
                      str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_compaction_keeps_the_last_writes(spark, rows, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    write = writers.entries(source, "title", "body", "seq")
    write(forms(spark, DRAFT), 0)
    write(forms(spark, (5, "A draft title", "Newer", None, "x", "draft")), 1)
    writers.compact_entries(spark, source, target, "title", "body")
    assert rows(writers.read_entries(spark, target, "title", "body")) == [("A draft title", "Newer")]
