"""Times every named query; prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    cores of the local session (default 8)
    BENCH_RUNS    timed runs per query after one warm-up of all; the median counts (default 3)

Arguments name the queries to run; all of them by default.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from servery.plans.queries import QUERIES
from servery.session import build_session


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "servery-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="servery-bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or sorted(QUERIES)
    seconds = {}
    for name in names:  # all code is compiled before anything is timed
        timed(spark, name, folder)
    taken = {name: [] for name in names}
    for run in range(runs):  # each time another query comes first
        turn = run * len(names) // runs
        for name in [*names[turn:], *names[:turn]]:
            taken[name].append(timed(spark, name, folder))
    for name in names:
        seconds[name] = round(statistics.median(taken[name]), 4)
        print(f"{name:28s}{seconds[name]:8.3f}", file=sys.stderr)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
