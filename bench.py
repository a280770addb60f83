"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_KEYS     comma-separated query keys, or "all" (default: the reports)
BENCH_RUNS     timed runs after two warm-ups; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from facetrank.session import build_session  # noqa: E402
from facetrank.workload.inputs import inputs, store_inputs  # noqa: E402
from facetrank.workload.queries import registered  # noqa: E402

HEADLINE = [
    "top_genre",
    "best_director",
    "best_director_for_genres",
    "facet_report",
    "facet_batch_exact",
    "facet_batch",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_KEYS", "")
    queries = registered()
    keys = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Deriving and storing the inputs is part of the work. The first load also
    # starts the JVM's code; the second is timed.
    inputs(spark, sf_dir)
    times = {"load_inputs": seconds(lambda: store_inputs(spark, sf_dir))}

    def run(key: str) -> None:
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for key in keys:
        for _ in range(2):
            run(key)
        times[key] = statistics.median(seconds(lambda: run(key)) for _ in range(runs))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "weighted facet ranking: one load plus the median of warm runs per query",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {key: round(value, 3) for key, value in times.items()},
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
