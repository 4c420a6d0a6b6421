"""Benchmark of the headline queries.

Runs each headline query (one warm-up, then the median of ``BENCH_REPEATS``
timed runs, each fully materialised with a no-op write) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "D9": "D9_run_dqa",
    "E3": "E3_interpolate_temporal",
    "C2": "C2_weather_fk_rebuild",
    "K7": "K7_build_fact",
    "D34": "D34_delay_by_state_month",
    "D16": "D16_discover_fd",
    "C11": "C11_fuzzy_duplicates",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from dwkit.plans.catalog import QUERIES
    from dwkit.session import drop_materialized, get_spark

    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="dwkit-bench-")  # a shared folder on a cluster
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.files.maxPartitionBytes": str(64 << 20)})
    times = {}
    rows = {}
    errors = {}
    for short, key in HEADLINE.items():
        fn = QUERIES[key]
        runs = []
        try:
            for i in range(repeats + 1):
                t0 = time.perf_counter()
                df = fn(spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i > 0:
                    runs.append(dt)
            times[short] = round(statistics.median(runs), 3)
            rows[short] = fn(spark, sf_dir).count()
            drop_materialized(spark)  # intermediates of this query are no longer read
        except Exception as e:  # noqa: BLE001 - report the failure, keep the other timings
            times[short] = None
            errors[short] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "rows": rows, "sf": sf, "cpus": cpus, "repeats": repeats}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
