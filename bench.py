"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_RUNS    timed runs per query, the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from bookloom.queries.registry import QUERIES
from bookloom.session import CHECKPOINT_DIR, build_session

HEADLINE = [
    "events_silver",
    "spend_silver",
    "daily_bookings_by_channel_distinct",
    "cpb_by_channel",
    "cumulative_bookings_by_source",
    "channel_campaign_daily_proportional",
    "booking_time_features",
    "employee_meetings_features",
    "cumulative_increment_day",
    "time_features_increment_local_day",
    "report_daily_pivot",
    "report_trend_weekly",
    "report_attribution_leaderboard",
    "report_slots_heatmap",
    "report_load_by_employee",
    "webhook_intake",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        CHECKPOINT_DIR: tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        # The first run compiles the plan and is not counted.
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
