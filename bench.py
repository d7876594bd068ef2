"""Benchmark: headline queries on the driver tables.

Runs each query 3 times into the `noop` sink (every column is evaluated,
nothing is collected) on local[$BENCH_CPUS] over $BENCH_SF_DIR, and prints ONE
JSON line: {"metric", "value", "unit", "queries": {name: median sec}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from silverline.plans.q_io import _write_by_product  # noqa: E402
from silverline.plans.registry import all_queries  # noqa: E402
from silverline.session import build_session  # noqa: E402

# Headline queries, mapped to the published figures they correspond to
# queries, the three ZIP variants.
HEADLINE = [
    "parquet_scan",            # Parquet sum(quantity) by key
    "date_filter_empty",       # Parquet count with every row group skipped
    "pruned_count",            # partition-pruned count of a table written before
    "partitioned_scan_filtered",  # the same with the partitioned write
    "stg_orders",
    "stg_users",
    "silver_build",            # silver build phase (models + 28 checks + export)
    "silver_build_observed",   # the same with row checks counted by the writes
    "dq_report",               # 28 checks as one report
    "product_share_pct",
    "monthly_report_all",
    "top_customers",
    "age_group_stats",
    "month_over_month",
    "running_total_daily",
    "ordered_every_product",
    "dq_zip_state_classified",
    "reconcile_same",
    "zip_native",
    "zip_python_udf",
    "zip_pandas_udf",
]
REPEATS = 3
WRITTEN: dict = {}


def pruned_count(spark, sf_dir):
    """Count of one partition of a table that is written outside the timing."""
    if sf_dir not in WRITTEN:
        WRITTEN[sf_dir] = _write_by_product(spark, sf_dir)
    return spark.read.schema("order_id bigint, product string").parquet(WRITTEN[sf_dir]).where("product = 'large'").groupBy().count()


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_JAVA_OPTS"):
        extra["spark.driver.extraJavaOptions"] = os.environ["BENCH_JAVA_OPTS"]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=partitions, extra_conf=extra)
    qs = all_queries() | {"pruned_count": pruned_count}
    names = only or HEADLINE
    # Warm-up: JVM start, class loading and file listing are not query time.
    run_once(spark, qs["parquet_scan"], sf_dir)
    results, best = {}, {}
    if "pruned_count" in names:
        pruned_count(spark, sf_dir)
    for name in names:
        times = [run_once(spark, qs[name], sf_dir) for _ in range(REPEATS)]
        results[name] = round(statistics.median(times), 4)
        best[name] = round(min(times), 4)
        print(f"# {name}: {[round(t, 3) for t in times]}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "queries_best_of_3": best,
        "sf": float(m.group(1)) if m else sf_dir,
        "repeats": REPEATS,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
