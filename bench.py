"""Wall-clock of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HEADLINE = [
    "low_availability", "net_delta", "net_delta_changelog", "turnover_ratio", "top_turnover",
    "ktable_latest", "asof_lookup", "decode_status", "quarantine_split", "to_topic_json",
    "feed_flatten", "ticks_scan", "pair_correlation", "pair_signals",
    "feed_entities", "stop_times", "next_arrival", "arrival_improvements", "arrival_message",
    "delay_propagation", "trip_completed", "cancelled_trips", "alert_targets", "active_alerts",
    "kv_upsert", "route_posts", "manifest_load", "log_partitions", "index_documents",
    "word_stream", "message_history", "plan_turnover", "plan_countdown",
    "stream_low_availability", "stream_next_arrival", "stream_net_delta", "stream_net_delta_changelog",
    "stream_arrival_improvements", "stream_top_turnover",
]


def main() -> None:
    from checks.queries import all_queries
    from feedloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, **{
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="feedloom-bench-")})
    queries, names = all_queries(), sys.argv[1:] or HEADLINE

    def timed(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    # Each query runs twice; the first run warms up code generation and is not counted.
    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(timed(name), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total wall-clock of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
