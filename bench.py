"""Headline queries on the driver tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from forgelake.plans.queries import runners  # noqa: E402

HEADLINE = [
    "handled_event_ratio", "duplicate_ratio", "event_feed", "staged_rows", "followers_table", "watchers_table", "project_commits_table",
    "commit_parents_table", "fork_points", "own_fork_commits", "inherited_commits", "pull_request_histories", "issue_events_table",
    "merged_by_commits", "commits_table", "dense_ids", "upserted_fields", "resolved_identities", "request_points", "worker_states", "sync_decisions", "text_dump_round_trip",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("forgelake-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = runners()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        def once() -> float:
            start = time.perf_counter()
            # Everything is computed and nothing comes back to the driver.
            available[name](spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        first = once()  # warm-up; also writes the stored tables the query reads
        repeats = RUNS if first < 10 else 1
        times[name] = round(statistics.median(once() for _ in range(repeats)), 3)
        print(f"{name}: first {first:.2f}, median {times[name]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
