"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the input and the cores, ``BENCH_SHARED_DIR`` the
folder for intermediate files; ``BENCH_RUNS`` (default
3) the timed passes over all queries, which follow an untimed one. Each value is the median
and includes building the plan; results go to a no-op sink, so that every column of every
row is computed and none is shipped to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tripmart.session import settings
from tripmart.standins.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "monthly_zone_revenue",
    "fact_trips",
    "stg_green",
    "stg_yellow",
    "stg_fhv",
    "dim_zones",
    "dedup_skewed",
    "zone_name_merge",
    "avg_int_and_decimal",
    "decode_payment",
    "csv_roundtrip",
    "load_months",
    "promote_stream",
    "check_unique",
    "check_relationships",
    "check_report",
    "build_warehouse",
)


def main() -> None:
    size = sum(e.stat().st_size for e in os.scandir(SF_DIR) if e.is_file())
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("tripmart-bench")
    for key, value in settings(size, CPUS).items():
        builder = builder.config(key, value)
    # every executor must reach this folder; on one machine the default will do
    builder = builder.config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/tripmart-bench"))
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {name: [] for name in names}
    for _ in range(RUNS + 1):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name].append(time.perf_counter() - start)
    medians = {name: round(statistics.median(taken[1:]), 3) for name, taken in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total_median_query_seconds",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
