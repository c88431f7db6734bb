"""Benchmark: run the registered checks at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely (noop sink, no collect) $BENCH_RUNS times
(default 2). The reported time per query is the best run, i.e. without the
one-time JVM class loading and code generation of its operators; the cold
(first-run) total is reported as well. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_RUNS (2), BENCH_QUERIES (comma list, default all), BENCH_SHUFFLE_PARTITIONS
(= cpus), BENCH_DRIVER_MEMORY (16g), BENCH_EVENT_LOG_DIR (write a Spark event
log for scripts/stage_report.py), BENCH_MIN_PARTITION (AQE minimum partition
size, for experiments).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sluice.session import build_session  # noqa: E402
from sluice.suite import load_all  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_MIN_PARTITION"):
        extra["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = os.environ["BENCH_MIN_PARTITION"]
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")      # optional: stage/task metrics per check
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                      "spark.eventLog.compress": "false"})
    spark = build_session(f"local[{cpus}]", app="sluice-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          extra=extra)
    registry = load_all()
    names = only or list(registry)
    # Warm-up: JVM class loading and code generation outside the timings.
    registry["coverage"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times, cold, failed = {}, {}, {}
    for name in names:
        fn = registry[name][0]
        try:
            best = None
            for i in range(runs):
                spark.sparkContext.setJobGroup(f"{name}#{i}", name)
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                el = time.perf_counter() - t0
                if i == 0:
                    cold[name] = round(el, 3)
                best = el if best is None else min(best, el)
            times[name] = round(best, 3)
        except Exception as e:  # keep going; report the failure
            failed[name] = str(e)[:200]
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cold_total": round(sum(cold.values()), 3), "runs": runs}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
