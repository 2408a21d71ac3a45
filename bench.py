"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each result is executed in
full through the ``noop`` sink (nothing is collected to the driver).  After
an untimed warm-up on the smallest fixture, every query runs ``$BENCH_RUNS``
times (default 3); the line reports the median per query and, for
transparency, the total of the first timed run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from threadlens.plans import queries as Q  # noqa: E402
from threadlens.session import build_session  # noqa: E402

HEADLINE = [
    "q_ingest", "q_snapshot", "q_first_post", "q_edges", "q_engagement", "q_degree_export",
    "q_recommend", "q_user_counts", "q_page_flatten", "q_minute_subreddits", "q_live", "q_als",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage and task times for `python -m threadlens.plans.eventlog <dir>`
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{cpus}]", app_name="threadlens-bench",
                          shuffle_partitions=max(cpus, 8), extra=extra)
    # warm-up, not timed: each query once on the smallest fixture, so the timed
    # runs measure the work, not JVM class loading and code generation
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            Q.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    samples = {name: [] for name in names}
    for _ in range(runs):
        for name in names:
            t0 = time.perf_counter()
            Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    first = round(sum(v[0] for v in samples.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "stat": f"median of {runs} runs", "first_run_total": first,
                      "samples": {name: [round(x, 3) for x in v] for name, v in samples.items()},
                      "warmup": os.path.basename(warm_dir) if os.path.isdir(warm_dir) else None}))
    spark.stop()


if __name__ == "__main__":
    main()
