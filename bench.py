"""Seconds per model and per named query; prints one JSON line.

The tables the queries start from are written first, and each write is timed as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from fixtures import registered
from inkwell.plans.warehouse import RELATIONS

WRITTEN = [
    "events",
    "articles",
    "accounts",
    "staged_events",
    "session_days",
    "session_traffic_sources",
    "last_non_direct",
    "session_activity",
    "pages",
    "articles_daily",
    "articles_by_reader_type",
    "paywall_daily",
    "paywall_sessions_daily",
    "events_daily",
    "touch_hits",
    "buyers",
    "journey_hits",
    "subscription_rows",
]
TIMED = ("m", "d", "mq", "g01", "i01_late", "i08")


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("inkwell-bench")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    w = registered.warehouse(spark, folder)
    times = {}
    for name in WRITTEN:
        assert name in w.inputs or name in RELATIONS
        times[f"write_{name}"] = seconds(lambda name=name: w.table(name))
    for name, query in registered.queries().items():
        if name.startswith(TIMED):
            times[name] = seconds(lambda query=query: query(spark, folder).collect())
    result = {
        "metric": "total seconds of table writes, models and named queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
