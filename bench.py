"""Time every registered query on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; print one JSON line.

Each query is planned and run to completion into a sink that discards its rows. The first query
runs once before the clock starts, to warm the JVM. With ``$BENCH_RUNS`` above 1 every query is
warmed up and the median of that many runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from attestry.plans.catalog import QUERIES
    from attestry.session import build_session

    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    names = [n for n in QUERIES if not only or n in only]

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    runs = int(os.environ.get("BENCH_RUNS", "1"))

    def measure(name: str) -> float:
        if runs > 1:
            run(name)
        return statistics.median(run(name) for _ in range(runs))

    run(names[0])
    times = {name: measure(name) for name in names}
    scale = re.search(r"sf([0-9.]+)$", folder.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
