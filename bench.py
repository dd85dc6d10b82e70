"""Benchmark the layered job on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Timed steps (one warm-up, then the median of ``BENCH_RUNS`` runs each):

* ``landing``: the three raw extracts derived from the tables, written as CSV;
* ``silver_build``: landed CSV -> cleaned, deduplicated silver tables and the
  enriched fact joined from them, written to the shared folder (rebuilt from
  scratch on every run);
* ``enriched_join``: the two joins alone (D8), from the stored silver tables;
* the headline results (D8, D9, D12, D17, D18) built over the stored silver
  layer and executed with the ``noop`` sink (full execution, no output);
* ``gold_build``: all seven gold / agg marts written as tables.

Prints ONE JSON line; ``value`` is the sum of the medians.
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

from ledgerlake.session import get_session  # noqa: E402

HEADLINE = [
    "sales_enriched",             # D8: scan of the stored fact
    "monthly_category_sales",     # D9: flagship mart
    "top_products_by_category",   # D12: aggregate + top-5 with ties
    "running_revenue",            # D17: month totals + running window
    "latest_order_per_customer",  # D18: newest row per customer
]


def _median_time(fn, runs: int) -> float:
    samples = []
    for i in range(runs + 1):
        t0 = time.perf_counter()
        fn()
        if i > 0:
            samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="ledgerlake-bench",
                        shuffle_partitions=max(8, 2 * cpus),
                        **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    from ledgerlake import registry as R
    from ledgerlake.plans.medallion import build_gold, build_silver
    from ledgerlake.session import scratch_dir

    root = scratch_dir(spark, "bench")
    bronze, timings = {}, {}
    timings["landing"] = _median_time(
        lambda: bronze.update(R.landed_bronze(spark, sf_dir, f"{root}/landing")), runs)
    # cleaning, dedup and both joins, from the landed files
    timings["silver_build"] = _median_time(lambda: build_silver(spark, bronze, root), runs)
    stored = R.silver(spark, sf_dir)
    # the two joins alone, from the stored silver tables
    timings["enriched_join"] = _median_time(
        lambda: stored.join_enriched().write.format("noop").mode("overwrite").save(), runs)
    rows: dict[str, int] = dict(stored.counts)
    for name in names:
        build = R.QUERIES[name]
        timings[name] = _median_time(
            lambda: build(spark, sf_dir).write.format("noop").mode("overwrite").save(), runs)
        rows[name] = build(spark, sf_dir).count()
    gold_counts = {}
    timings["gold_build"] = _median_time(
        lambda: gold_counts.update(build_gold(stored)), runs)
    rows.update(gold_counts)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "layered_job_median_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
