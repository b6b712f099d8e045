"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS`` timed
runs, each writing all rows to the ``noop`` sink. Prints one JSON line; ``cold``
holds the first run of each query (``dq_*`` write the models they check in it,
the later runs read them while the input files stay the same).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vatio.registry import QUERIES  # noqa: E402
from vatio.session import get_session  # noqa: E402

HEADLINE = ["stg_generation", "generation_enriched", "daily_by_technology", "daily_by_plant",
            "plant_efficiency", "system_summary", "training_solar", "dq_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="vatio-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    times, cold = {}, {}
    for name in names:
        samples = []
        for _ in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        cold[name] = round(samples[0], 3)
        times[name] = round(statistics.median(samples[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold, "sf": sf}))


if __name__ == "__main__":
    main()
