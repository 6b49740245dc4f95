"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, of which the fastest counts (default 2)
BENCH_SMALL   folder of smaller tables, run once each to show growth (default sf0.01 beside the other)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.queries import registry  # noqa: E402
from corpusloom.session import local_session, release_tables  # noqa: E402

HEADLINE = [
    "flagship", "quality_filter", "lexicon_label_clinical", "render_response", "dedup_pair",
    "dedup_priority", "balance_classes", "stratified_split", "leakage_check", "hard_negatives",
    "preference_dataset", "pii_mask", "pii_report", "split_dist", "length_profile",
    "chat_format", "chat_render_conversation", "eval_metrics", "eval_compare", "latency_stats",
    "build_dataset",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", cores)
    small = os.environ.get("BENCH_SMALL", os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.01"))
    known, times, small_times = registry(), {}, {}

    def timed(query, where: str) -> float:
        begun = time.perf_counter()
        query(spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    for name in sys.argv[1:] or HEADLINE:
        query = known[name][0]
        times[name] = round(min(timed(query, folder) for _ in range(runs)), 3)
        if os.path.isdir(small) and small != folder.rstrip("/"):
            small_times[name] = round(timed(query, small), 3)
    line = {
        "metric": "total_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "runs": runs,
        "small_queries": small_times,
    }
    release_tables(spark)
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
