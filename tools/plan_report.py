"""Summarise the physical plan of every registered query into PLANS.md.

For each query: shuffles (hash / range / round-robin), broadcasts, join
strategies, aggregate kinds, window operators, partial top-k limits and
whether scans carry pushed filters. Plans are the planner's static choice
(AQE may still convert a sort-merge join to a broadcast at run time).

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.session import get_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "round-robin shuffles": r"Exchange RoundRobinPartitioning",
    "single-partition shuffles": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "nested-loop joins": r"BroadcastNestedLoopJoin|CartesianProduct",
    "hash aggregates": r"HashAggregate\(",
    "sort aggregates": r"SortAggregate\(",
    "windows": r"\bWindow \[",
    "partial top-k limits": r"WindowGroupLimit .*Partial",
    "scans": r"FileScan ",
    "scans with pushed filters": r"PushedFilters: \[[^\]]",
}


def summarise(plan: str) -> dict[str, int]:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    # the planner's choice at scale: no size-based broadcast of data tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    from ledgerlake.registry import QUERIES
    cols = list(PATTERNS)
    print(f"# Physical plans of the registered queries\n\nInput `{sf_dir}`, "
          "broadcast threshold off (the plan a 100 TB input gets). Counts of operators in "
          "the static physical plan; queries downstream of silver read the "
          "stored silver tables.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    from ledgerlake.plans.silver import clean_customers
    from ledgerlake.registry import customers_extract, silver
    steps = {
        "silver: customers (dedup)": lambda s, d: clean_customers(customers_extract(s, d)),
        "silver: enriched joins": lambda s, d: silver(s, d).join_enriched(),
    }
    for name, fn in {**steps, **QUERIES}.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
