"""Time the named queries: one JSON line with seconds per query.

Each query is run once to warm up and then ``BENCH_RUNS`` times (default 1); the median
counts.  Results go to a sink that discards them, so no row passes through the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallymill.queries import QUERIES
from tallymill.session import build_session


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "").split()
    spark = build_session("bench", f"local[{cpus}]", **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in QUERIES.items():
        if chosen and name not in chosen:
            continue
        run(query, spark, sf_dir)
        seconds[name] = round(statistics.median(run(query, spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
