"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best run is kept).  Each query's result is fully
materialised with the ``noop`` sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changefeed.plans.queries import QUERIES  # noqa: E402
from changefeed.session import build_session  # noqa: E402

# Every registered change-feed query.
HEADLINE = list(QUERIES)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session("changefeed-bench", f"local[{cpus}]",
                          {"spark.sql.shuffle.partitions": str(cpus),
                           "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("changes_flat")  # warm-up: JVM, codegen caches
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        try:
            times[name] = round(min(run(name) for _ in range(repeat)), 4)
        except Exception as exc:  # report the rest rather than lose the whole run
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
