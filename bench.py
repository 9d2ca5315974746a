"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, one JSON line.

``store_tables`` is the time to derive both stores from the driver's files and to write them as
Parquet tables; the operators then run over those tables, as they would over a stored shop. Each
query is timed from building its frame to computing every output row and column. All times,
``store_tables`` too, are part of the total. Nothing runs twice and nothing is cached. The queries named
``…_tables`` write every table that a job leaves behind, and hash all of it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopweave.checks.queries import QUERIES, Inputs  # noqa: E402
from shopweave.checks.store_frames import DerivedStore, StoredStore  # noqa: E402
from shopweave.session import Workspace, local_session  # noqa: E402

HEADLINES = [
    "orders_wide",
    "orders_wide_light",
    "order_addresses",
    "order_operational",
    "copy_order_meta",
    "product_catalog",
    "product_catalog_in_stock",
    "write_catalog_csv",
    "catalog_batches",
    "latest_products",
    "missing_customers",
    "insert_ignore",
    "customer_import_stats",
    "export_order_itemmeta",
    "convert_statuses",
    "sync_statuses_exact",
    "sync_statuses_wide",
    "status_distribution_pct",
    "integrity_check",
    "order_validation",
    "job_migrate_customers",
    "job_migrate_orders",
    "job_orders_complete",
    "job_full",
    "job_sync_exact",
    "job_validate",
    "job_convert_wide_tables",
    "job_full_tables",
    "job_fix_statuses_tables",
    "job_sync_exact_tables",
]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    memory = os.environ.get("BENCH_MEMORY", "12g")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, memory, "bench")
    run(spark.range(1000).groupBy("id").count())  # the session's own start is no query's time
    start = time.perf_counter()
    root = Workspace(spark).location("stores")
    store = StoredStore(spark, DerivedStore(spark, sf_dir), root)
    seconds = {"store_tables": round(time.perf_counter() - start, 3)}
    for name in names:
        start = time.perf_counter()
        run(QUERIES[name](Inputs(spark, store)))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
