"""Time the headline queries on the test tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.checks.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "rpt_latest_status",
    "rpt_daily_status_counts",
    "rpt_avg_duration",
    "rpt_freshness",
    "rpt_week_over_week",
    "rpt_overlap",
    "join_interval_overlap",
    "rpt_most_viewed",
    "rpt_top_users",
    "alert_duration_anomaly",
    "alert_stale",
    "merge_refresh",
    "merge_events",
    "agg_midpoint_watermark",
    "join_registry_resolve",
    "triage_endpoint_stats",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))


def seconds(spark, name: str, sf_dir: str) -> float:
    """One run, written nowhere so that every row is computed and none is moved to Python."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)  # warm-up
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
