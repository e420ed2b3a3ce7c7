"""Benchmark the headline queries.

Runs each query to completion with the ``noop`` sink (the whole plan executes, nothing is
collected to the driver) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints one JSON
line: {"metric", "value", "unit", "queries": {name: seconds}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from triplake import catalog  # noqa: E402
from triplake.session import build_session  # noqa: E402

HEADLINE = [
    "market_share_monthly", "financial_kpis_monthly", "territorial_demand", "temporal_patterns",
    "clean_taxi_staging", "dedup_yellow", "quarantine_reasons", "profile_duplicates",
    "profile_accounting_gap", "staging_roundtrip", "mart_incremental", "stream_arrival",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="triplake-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 # partitions sized for tens of MB per stage (a cluster at 100 TB uses 128-256 MB)
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes":
                                     os.environ.get("BENCH_ADVISORY_PARTITION", "16m")})
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    qs["market_share_monthly"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # JVM / codegen warm-up
    times = {}
    for name in only:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    # trip rows behind the queries (Parquet footer counts): taxi trips = lineitem rows, app/for-hire = events
    trips = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "events")}
    rate = {}
    if "clean_taxi_staging" in times:
        rate["clean_taxi_rows_per_sec"] = round(trips["lineitem"] / times["clean_taxi_staging"])
    if "market_share_monthly" in times:
        rate["market_share_rows_per_sec"] = round((trips["lineitem"] + 2 * trips["events"])
                                                  / times["market_share_monthly"])
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "trip_rows": trips, **rate}))


if __name__ == "__main__":
    main()
