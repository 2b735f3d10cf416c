"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of local cores.
``BENCH_QUERIES``, a comma-separated list, restricts the run.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession

from hazeline.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    shared = tempfile.mkdtemp(prefix="hazeline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("hazeline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # Start the JVM's code paths and the Python workers before the clock counts.
    for name in ("pm25_ranked", "fetch_counts"):
        run(name)
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total time of the registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
