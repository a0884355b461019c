"""Run all queries on one scale factor and print their times as one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
A query's time is building it and computing every row into the noop sink. Tables
and models several queries share are made once; ``prepare`` has the time that
takes, and the total includes it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from basketloom.plans.catalog import QUERIES, prepare_steps


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("basketloom-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    prepare = {}
    if len(sys.argv) == 1:
        for what, make in prepare_steps(spark, sf_dir).items():
            start = time.perf_counter()
            make()
            prepare[what] = round(time.perf_counter() - start, 3)
    times = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_wall_time_all_queries",
                "value": round(sum(times.values()) + sum(prepare.values()), 3),
                "unit": "sec",
                "queries": times,
                "prepare": prepare,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
