"""Post pipelines: landing loads and submitted forms."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.operators import landing, posts, quality
from feedloom.sinks import landing as landing_sink
from feedloom.sinks import writers
from feedloom.sources import files


def import_snapshot(snapshot: DataFrame, path: str, manifest_path: str, at: datetime) -> str:
    """Land a snapshot and announce it."""
    target = landing_sink.land_snapshot(snapshot, path, landing_sink.run_stamp(at))
    spark = snapshot.sparkSession
    landing_sink.notify(spark.createDataFrame([(target,)], "s3_path string"), manifest_path)
    return target


#: Objects that one read names; a batch of notifications with more takes several reads.
PATHS_AT_ONCE = 1000


def announced_records(manifest: DataFrame) -> DataFrame:
    """The records of exactly the announced objects, those that cannot be read included.

    A path that ends in ``.json`` is one document, an array as fetched; any
    other is a directory of JSON lines as landed here.  Nothing else is listed
    or read, and an object that is missing fails the load.
    """
    spark = manifest.sparkSession
    kinds = [*schemas.POST_JSON.fields, *(T.StructField(n, T.StringType()) for n in (quality.CORRUPT, landing.RUN))]
    loaded = []

    def load(paths: list[str]) -> None:
        whole = [p for p in paths if p.endswith(".json")]
        for group, multi_line in ((whole, True), ([p for p in paths if p not in set(whole)], False)):
            if group:
                loaded.append(landing.with_run(files.post_records(
                    spark, group, multi_line=multi_line, runs=False)))

    paths: list[str] = []
    for row in landing.announced_paths(manifest).toLocalIterator():
        paths.append(row["s3_path"])
        if len(paths) == PATHS_AT_ONCE:
            load(paths)
            paths = []
    load(paths)
    return reduce(DataFrame.unionByName, loaded, spark.createDataFrame([], T.StructType(kinds)))


def load_announced(manifest: DataFrame) -> DataFrame:
    """Posts of all announced snapshots."""
    return landing.project_posts(files.good(announced_records(manifest)))


def announced_runs(manifest: DataFrame, landing_path: str) -> DataFrame:
    """(s3_path, ingest_ts) of the notifications; the run is null for what is no run below ``landing_path``."""
    paths = landing.announced_paths(manifest)
    root = F.lit(landing_path.rstrip("/") + f"/{landing.RUN}=")
    rest = F.rtrim(F.substring(F.col("s3_path"), F.length(root) + 1, F.length("s3_path")), F.lit("/"))
    run = F.when(F.startswith("s3_path", root) & (F.length(rest) > 0) & ~F.contains(rest, F.lit("/")), rest)
    return paths.select("s3_path", run.alias(landing.RUN))


def landed_records(manifest: DataFrame, landing_path: str) -> DataFrame:
    """The records of the announced runs below ``landing_path``, those that cannot be read included.

    One read of the landing table, joined with the runs: the plan does not grow with
    the notifications, and directories that none of them names are pruned when the
    query runs.  A manifest beyond Spark's size for broadcasts is joined by a
    shuffle; then all runs are read, with the same result.  Runs that were not
    landed, and other paths, give nothing here: see :func:`not_landed`.
    """
    records = files.post_records(manifest.sparkSession, landing_path, multi_line=False)
    runs = announced_runs(manifest, landing_path).where(F.col(landing.RUN).isNotNull()).select(landing.RUN).distinct()
    return records.join(runs, landing.RUN, "left_semi")


def not_landed(manifest: DataFrame, landing_path: str) -> DataFrame:
    """``s3_path`` of the notifications that name no landed run; the files are listed, not read."""
    listed = manifest.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.json").load(landing_path)
    held = (listed.select(F.regexp_extract("path", f"/{landing.RUN}=([^/]+)/[^/]+$", 1).alias(landing.RUN))
            .where(F.length(landing.RUN) > 0).distinct())
    return announced_runs(manifest, landing_path).join(held, landing.RUN, "left_anti").select("s3_path")


def load_landed(manifest: DataFrame, landing_path: str) -> DataFrame:
    """Posts of all announced runs of one landing table."""
    return landing.project_posts(files.good(landed_records(manifest, landing_path)))


def load_on_notification(write: writers.BatchWriter, bad: writers.BatchWriter | None = None,
                         landing_path: str | None = None) -> writers.BatchWriter:
    """For a stream of notifications: load what each batch of them announces.

    Records that cannot be read go to ``bad``; without it they fail the batch.
    With ``landing_path`` all notifications name runs of that landing table, which
    is read once; one that names no landed run fails the batch.
    """
    def records_of(notices: DataFrame) -> DataFrame:
        if landing_path is None:
            return announced_records(notices)
        lost = not_landed(notices, landing_path).first()
        if lost is not None:
            raise ValueError(f"announced, but not landed: {lost['s3_path']}")
        return landed_records(notices, landing_path)

    def run(notices: DataFrame, batch_id: int) -> None:
        records = records_of(notices)
        if bad is not None:
            bad(files.corrupt(records), batch_id)
        elif not files.corrupt(records).isEmpty():
            raise ValueError("an announced object holds records that cannot be read")
        write(landing.project_posts(files.good(records)), batch_id)
    return run


def save_forms(entries_path: str, table_path: str) -> writers.BatchWriter:
    """Drafts to key-value entries, everything else to the posts table."""
    def write(df: DataFrame, batch_id: int) -> None:
        routed = posts.route_posts(df)
        writers.fan_out([
            lambda rows, n: writers.entries(entries_path, "title", "body", "seq")(
                posts.draft_entries(rows), n),
            lambda rows, n: writers.files(table_path)(posts.table_rows(rows), n),
        ])(routed, batch_id)
    return write
