"""Seconds per registered query at one scale, as one JSON line.

Every query is built and run in full (all columns of all rows), once to warm up
and then timed; the figure is the better of two timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from daybook.plans.catalogue import QUERIES
from daybook.session import local_session


def seconds(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or list(QUERIES)
    spark = local_session(cores, app="daybook bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        seconds(QUERIES[name], spark, folder)
        times[name] = round(min(seconds(QUERIES[name], spark, folder) for _ in range(2)), 3)
    line = {
        "metric": "sum over queries of the better of two warm runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
