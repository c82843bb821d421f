"""Benchmark the headline queries.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints ONE JSON line. Each query is executed in full through the ``noop``
sink (every row computed, nothing collected to the driver).

The JVM is warmed up first (JIT, class loading) by running two queries on the
smallest data set, untimed; nothing computed there is reused by the timed runs
(materialised tables are keyed by data folder).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "engineered",
    "clean_pipeline",
    "score_describe",
    "score_histogram",
    "risk_distribution",
    "correlation_pairs",
    "box_stats",
    "top_drivers",
    "cohort_drivers",
    "request_text",
    "answers_wide",
    "rejected_answers",
    "answers_end_to_end",
    "model_lr",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from wellscore.plans.queries import queries
    from wellscore.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="wellscore-bench")
    qs = queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in ("engineered", "answers_wide"):
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    from wellscore.sources.fixtures import orders

    # what all derived tables are read from is written once; it has a line of its own
    t0 = time.perf_counter()
    orders(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {"deal_orders": round(time.perf_counter() - t0, 3)}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
