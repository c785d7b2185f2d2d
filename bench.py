"""Timings of the headline queries; prints one JSON line.

Measured: parsing all lines, the five rollups from lines, the flagship report from lines, the ingestion stream into
stored tables, and every report over the stored tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowledger.plans.queries import CLOCK, REPORT_QUERIES, all_queries  # noqa: E402
from flowledger.plans.reports import REPORTS  # noqa: E402
from flowledger.plans.stored_queries import ingested_at_once, streamed_store  # noqa: E402
from flowledger.session import configure  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FROM_LINES = ("P_records", "R1_daily_aggregation", "R2_hourly_traffic", "R3_top_destinations", "R4_top_applications",
              "R5_subscriber_bandwidth", "Q09_top_subscribers_today")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("flowledger-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="flowledger-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    queries = all_queries()
    run(queries["P_records"](spark, SF_DIR))  # starts the JVM's compiled code and the readers
    timings = {}
    for name in FROM_LINES:
        timings[name] = seconds(lambda: run(queries[name](spark, SF_DIR)))
    timings["W1_ingest_stream"] = seconds(lambda: ingested_at_once(spark, SF_DIR))
    tables = streamed_store(spark, SF_DIR).tables()
    for name in REPORT_QUERIES:
        timings[f"stored_{name}"] = seconds(lambda: run(REPORTS[name](tables, CLOCK)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "slowest_stored_report": max(v for k, v in timings.items() if k.startswith("stored_")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
