"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and executes the whole plan with the ``noop`` sink (no
collect to the driver). Prints ONE JSON line:

  {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each time is the median of ``$BENCH_REPEAT`` (default 1) warm runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "training_frame", "horse_history", "jockey_history", "horse_summary", "feature_frame",
    "metrics_all", "auc_roc", "ndcg", "best_threshold", "backtest_metrics", "leakage_report",
    "temporal_split", "time_folds", "label_encode", "standard_scale", "csv_mapping", "race_dim",
    "quality_report", "threshold_alerts", "run_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else "8"))

    from paddock.plans.catalog import QUERIES, load_all
    from paddock.session import local_session

    spark = local_session(cpus, parts, app="paddock-bench")
    load_all()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        return dt

    run("group_sizes")                      # JVM / parquet warm-up
    times = {}
    for n in names:
        if n not in QUERIES:
            continue
        runs = [run(n) for _ in range(repeat)]
        times[n] = round(statistics.median(runs), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir,
                      "cpus": cpus, "shuffle_partitions": parts, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
