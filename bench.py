"""Headline timings: runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query runs once as a warm-up (which also writes
the per-session extract folders), then $BENCH_RUNS times; the median is
reported.  Results are forced with a no-op write (every row computed, nothing
collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans import catalog  # noqa: E402
from lodestar.session import local_session  # noqa: E402

HEADLINE = [
    "job_standard_delta",
    "job_cube_delta",
    "job_stock_delta",
    "activate_standard",
    "activate_cube",
    "activate_marker",
    "attr_all",
    "calendar",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus * 2), app="lodestar-bench")
    out: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "rows_out": rows,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
