"""Time the headline queries and print one JSON line.

BENCH_SF_DIR chooses the data (default sf0.1), BENCH_CPUS the local cores. Every
query runs up to BENCH_RUNS times (default 3) and its median counts; no further
round begins after BENCH_SECONDS (default 240).
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardspark.session import local_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "family_pos", "family_kpis_pos", "family_monthly_kpis", "spend_last_months", "type_counts", "card_kpis",
    "rollup_months", "normalize_rollup", "weighted_age", "usage_summary", "categorize", "customer_changes",
    "resolve_users", "contact_ambiguity", "score_clusters", "top_merchants", "write_monthly",
    "resolve_incremental", "propagate_master", "clusters", "ingest_files", "append_day",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "12g"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()
    runs: dict[str, list[float]] = {name: [] for name in names}
    began = time.perf_counter()
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        if all(runs.values()) and time.perf_counter() - began > float(os.environ.get("BENCH_SECONDS", "240")):
            break
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
    seconds = {name: round(median(times), 3) for name, times in runs.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
