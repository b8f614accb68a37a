"""Time all registered queries on one machine and print one JSON line.

Every query is run once to warm up and then timed in full, from building the plan to the last
row, writing to Spark's ``noop`` sink so that no result is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tripwright.plans.queries import QUERIES


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripwright-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(QUERIES)
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        seconds[name] = round(timed(spark, name, folder), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    line = {
        "metric": "all queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
