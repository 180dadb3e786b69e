"""Benchmark the registered queries.

Runs every ``queries()`` key at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``: one warm-up pass, then the
median of ``$BENCH_REPS`` (default 3) timed runs per query. A run executes
the whole plan through the ``noop`` sink (nothing is collected to the
driver). Prints one JSON line; ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from strata.session import build_session

    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    spark = build_session(
        f"local[{cpus}]", app_name="strata-bench", shuffle_partitions=cpus,
        extra={"spark.driver.memory": "16g", "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    from strata.plans.registry import QUERIES

    names = only or list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up: JIT, file listing caches, Python imports
        run(name)
    results = {}
    for name in names:
        results[name] = round(statistics.median(run(name) for _ in range(reps)), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "reps": reps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
