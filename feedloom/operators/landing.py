"""Landing zone: JSON array snapshots, the manifest that announces them, and posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = "ingest_ts"


def project_posts(posts: DataFrame) -> DataFrame:
    """The columns of the ``posts`` table."""
    kept = [c for c in (RUN,) if c in posts.columns]
    return posts.select("id", "userId", "title", "body", *kept)


def first_per_id(posts: DataFrame, order: str | Column = "userId") -> DataFrame:
    """Optional guard for replays: one row per post id, the first by ``order``."""
    order = F.col(order) if isinstance(order, str) else order
    return posts.groupBy("id").agg(
        *[F.min_by(c, order).alias(c) for c in posts.columns if c != "id"])


def announced_paths(manifest: DataFrame) -> DataFrame:
    """Distinct ``s3_path`` of the notifications; messages without a path are ignored."""
    return manifest.where(F.length("s3_path") > 0).select("s3_path").distinct()


def with_run(posts: DataFrame) -> DataFrame:
    """Add the run that the directory of a row's file names, null where it names none."""
    run = F.regexp_extract(F.input_file_name(), rf"{RUN}=([^/]+)", 1)
    return posts.withColumn(RUN, F.nullif(run, F.lit("")))
