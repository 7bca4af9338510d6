"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is forced end to end with the ``noop`` sink (every row computed,
nothing collected to the driver). Queries that persist state (keyed tables,
landing batches) write under the session's checkpoint folder. ``load_ledger``
includes the loads, task runs and refreshes that the reports after it read.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riverbed.plans.queries import REGISTRY  # noqa: E402
from riverbed.session import get_session  # noqa: E402

HEADLINE = [
    "txn_parsed", "txn_status_counts", "txn_invalid", "merchant_scd1", "client_scd2",
    "fraud_full", "trans_all_clients", "fraud_archive", "newest_rows", "table_counts",
    "conformed_replay", "conformed_upsert", "txn_invalid_incremental", "client_dim_incremental",
    "fraud_incremental", "wide_normalise_trans", "wide_normalise_client", "load_ledger",
    "load_stats", "refresh_history", "ingest_csv", "fraud_full_sweep", "v2_pipeline_fact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="riverbed-bench",
                        shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # Warm the JVM (class loading, first write) outside the timed region.
    REGISTRY["txn_status_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    # Land the derived raw tables once, outside the timed region.
    for name in ("merchant_parsed", "client_parsed"):
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
