"""Landing snapshots and the notifications that name them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.landing import RUN

#: Fixed format of a run's time stamp.
STAMP = "%Y%m%d%H%M%S"


def run_stamp(at: datetime) -> str:
    return at.strftime(STAMP)


def land_snapshot(posts: DataFrame, path: str, run: str) -> str:
    """Write one snapshot below its run's directory; returns that directory."""
    target = f"{path.rstrip('/')}/{RUN}={run}"
    posts.write.mode("overwrite").json(target)
    return target


def land_runs(posts: DataFrame, path: str) -> None:
    """Write the snapshots of several runs (column ``ingest_ts``) in one job; each replaces its own directory only."""
    posts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).json(path)


def notify(snapshots: DataFrame, manifest_path: str) -> None:
    """Append one notification per landed snapshot (column ``s3_path``)."""
    (snapshots.select("s3_path", F.lit("post").alias("body"))
     .write.mode("append").json(manifest_path))
