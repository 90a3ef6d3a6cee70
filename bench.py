"""Time every registered query and print one JSON line.

Each query runs twice in a row. The second run is reported and summed; the first,
which also compiles code and starts Python workers, is given under "first_run".

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names, default all).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tickstream.plans.registry import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    first, seconds = {}, {}
    for name in names:
        first[name], seconds[name] = run(name), run(name)
        print(f"{name} {first[name]} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "first_run_value": round(sum(first.values()), 3),
        "queries": seconds,
        "first_run": first,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
