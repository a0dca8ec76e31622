"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed end to end with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver): one warm-up, then ``$BENCH_RUNS`` timed
runs (default 3), median reported.
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
    "scorecard_stages",
    "correlation_quality",
    "correlation_rules",
    "dedup_patterns",
    "finding_clusters",
    "stratified_sample",
    "stratified_split",
    "sft_texts",
    "chatml_validation",
    "completion_scores",
    "rationale_backfill",
    "histograms",
    "dataset_metadata",
    "correlation_edges",
    "verifier_issue_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from vigil.plans.registry import registry
    from vigil.session import build_session

    spark = build_session(app_name="vigil-bench")
    reg = registry()
    names = only or HEADLINE
    out: dict[str, float] = {}
    for name in names:
        fn = reg[name].fn
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
