"""Benchmark the headline jobs; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median is reported).
Queries are forced with the ``noop`` sink, so all work runs but nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans import build, serving  # noqa: E402
from ledgerline.session import build_session, checkpoint_root, scratch_path  # noqa: E402
from ledgerline.sources.binding import bind_raw  # noqa: E402
from ledgerline.streaming.backlog import assign_batches, run_backlog  # noqa: E402
from ledgerline.streaming.pipeline import run_pipeline  # noqa: E402
from ledgerline.streaming.publish import Warehouse  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app_name="ledgerline-bench", shuffle_partitions=2 * cpus,
                          extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    raw = bind_raw(spark, sf_dir)
    n_orders = raw["raw_orders"].count()
    n_batches = -(-n_orders // 5000)

    def fact_orders():
        force(build.full_fact_orders(bind_raw(spark, sf_dir)))

    def orders_serving():
        force(serving.build_orders_serving(bind_raw(spark, sf_dir)))

    def batch_assignment():
        force(assign_batches(bind_raw(spark, sf_dir)["raw_orders"], 5000))

    def backlog_load():
        store = Warehouse(spark, scratch_path(spark, "bench-wh"))
        run_backlog(spark, bind_raw(spark, sf_dir), store)

    prepared = {}

    def prepare_upsert():
        store = Warehouse(spark, scratch_path(spark, "bench-wh"))
        run_backlog(spark, bind_raw(spark, sf_dir), store, max_batches=max(n_batches - 1, 1))
        prepared["store"] = store
        prepared["version"] = store.version

    def loop_one_batch_upsert():
        # One 5,000-order batch upserted into the warehouse holding all earlier batches.
        src = prepared["store"]
        store = Warehouse(spark, src.root)
        run_pipeline(spark, bind_raw(spark, sf_dir), store, max_batches=1)

    jobs = {
        "fact_orders": (fact_orders, None),
        "orders_serving": (orders_serving, None),
        "batch_assignment": (batch_assignment, None),
        "backlog_load": (backlog_load, None),
        "loop_one_batch_upsert": (loop_one_batch_upsert, prepare_upsert),
    }
    results = {}
    for name, (fn, prep) in jobs.items():
        times = []
        for i in range(runs + 1):
            if prep:
                prep()
            t0 = time.perf_counter()
            fn()
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_jobs_total_median_sec", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "runs": runs, "orders": n_orders, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
