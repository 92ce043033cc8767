"""Times the registered queries and prints one JSON line.

Each query runs to a no-op sink; streaming queries run their stream to the end
first. The time of a query is the median of three runs after one warm-up. The
window queries on the clock are left out: they wait for their windows to close.

    BENCH_SF_DIR  folder of tables, default /root/testdata/sf0.1
    BENCH_CPUS    threads, default 8
"""

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tallystream.plans import QUERIES

ON_THE_CLOCK = ("windows_append", "windows_append_sql", "windows_messages")
RUNS = 3


def once(spark, query, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or [n for n in QUERIES if n not in ON_THE_CLOCK]
    times = {}
    for name in names:
        once(spark, QUERIES[name], sf_dir)
        runs = [once(spark, QUERIES[name], sf_dir) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 4)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": rows,
                "cpus": int(cpus),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
