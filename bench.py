"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is run once to warm up; the median of the next runs is reported. All rows are
produced (no-op sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rankloom.plans.queries import QUERIES
from rankloom.session import local_session

HEADLINE = (
    "trend_board",
    "daily_edition",
    "content_audit",
    "link_audit",
    "manifest_audit",
    "board_entries",
    "midrank_percentile",
    "evidence_asof_reuse",
    "parse_pages",
    "duplicate_fingerprints",
    "localized_validation",
    "active_references",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        measured = []
        for run in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run:
                measured.append(time.perf_counter() - started)
        times[name] = round(statistics.median(measured), 3)
    spark.stop()
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    line = {
        "metric": "headline_queries_median_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
