"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Settings every deployment should carry.  Shuffle width is left to the
#: cluster: AQE coalesces small partitions and splits skewed join partitions.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(app: str = "feedloom", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.shuffle.partitions": str(cores),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def pin_utc(spark: SparkSession) -> SparkSession:
    """Windows and date parsing are defined in UTC, whatever the host zone is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory that every executor can reach.

    Taken below ``spark.checkpoint.dir`` as the cluster names it.  A folder of
    this machine serves only a session that runs within it, as in tests; any
    other session has to name a shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
