"""The layered job: raw -> bronze -> silver (stored) -> gold / agg tables.

Silver is written once and everything downstream reads the stored tables:

* lineage is cut at a durable point in the shared folder (under
  ``spark.checkpoint.dir``), so a lost executor costs a re-read, not a
  recompute of the landing parse, dedup and joins;
* marts read only the columns they use (Parquet column pruning);
* both inputs of the enriched joins are fresh scans, so each join gets its
  own shuffles and AQE can split a skewed key (a hot customer or product)
  on either join; with in-memory frames the dedup's partitioning would be
  reused and block that split.

Each extract is parsed once: one pass writes its silver rows, the rows the
rules drop and the rejected ones apart (``plans.quarantine``) and counts what
the quality report states. Marts the reference shows sorted are written in
that order (``operators.ordered``), the others straight from the tasks that
compute them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.concurrency import run_concurrently
from ledgerlake.operators.ordered import sorted_rows
from ledgerlake.plans import gold
from ledgerlake.plans import quarantine as qr
from ledgerlake.plans.silver import dedup_customers, enrich, financial_orders, is_active
from ledgerlake.session import scratch_dir
from ledgerlake.sources.store import KINDS, CatalogStore, PathStore

Store = PathStore | CatalogStore
ENRICHED = "silver_sales_enriched"
REJECTED = "rejected_rows"


def _write_task(store: Store, name: str, df: DataFrame) -> Callable[[], int]:
    order = gold.SHOWN_ORDER.get(name)
    return lambda: store.write(name, sorted_rows(df, order) if order else df)["rows"]


@dataclass
class StoredSilver:
    """The silver tables of a store; every property is a fresh scan."""

    store: Store
    counts: dict[str, int] = field(default_factory=dict)
    # dataset -> what its write counted (see ``quarantine.write_metrics``)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def root(self) -> str:
        return self.store.root

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    @property
    def customers(self) -> DataFrame:
        return self.table("silver_customers")

    @property
    def products(self) -> DataFrame:
        return self.table("silver_products")

    @property
    def orders(self) -> DataFrame:
        return self.table("silver_orders")

    @property
    def financial_orders(self) -> DataFrame:
        return financial_orders(self.orders)

    @property
    def rejected(self) -> DataFrame:
        """One row per value that could not be parsed."""
        return self.table(REJECTED)

    @property
    def typed(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """All rows of customers, products and orders, typed, whatever became
        of them."""
        return tuple(self.table(t) for t in ("all_customers", "typed_products", "typed_sales_orders"))

    def join_enriched(self) -> DataFrame:
        """D8 from the three stored tables (fresh scans on both join sides)."""
        return enrich(self.financial_orders, self.products, self.customers)

    @property
    def enriched(self) -> DataFrame:
        """The stored enriched fact."""
        return self.table(ENRICHED)


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str | None = None,
                 fmt: str = "parquet", on_bad: str = "fail", store: Store | None = None) -> StoredSilver:
    """Type, split and store the three bronze frames (D4-D6, one pass each),
    keep the latest customer versions, then store the enriched fact joined
    from the stored tables (D8).

    ``on_bad`` is a mode of ``plans.quarantine``; ``"fail"`` raises
    ``ParseFailure`` once the reject rows are stored.
    """
    store = store or PathStore(spark, root or scratch_dir(spark, "silver"), fmt)

    def split(name: str) -> dict[str, int]:
        rows = qr.typed_with_kinds(bronze[name], name, on_bad)
        # orders and customers meet on the customer
        bucket = "customer_id" if name == "sales_orders" else None
        return store.write_split(f"split_{name}", rows, qr.parts(name, rows.columns),
                                 qr.write_metrics(name), bucket)

    metrics = run_concurrently({name: (lambda name=name: split(name)) for name in qr.DATASETS})
    counts = {"silver_products": metrics["products"]["good_rows"],
              "silver_orders": metrics["sales_orders"]["good_rows"]}
    counts[REJECTED] = store.write(REJECTED, qr.reject_rows(
        {name: store.read(f"rejected_{name}") for name in qr.DATASETS}))["rows"]
    if on_bad == "fail" and (failures := qr.strict_failures(metrics)):
        raise qr.ParseFailure(f"values that can't be parsed: {failures}; see {REJECTED}")

    # customers: the latest version, counted, then the active ones
    latest = dedup_customers(store.read(qr.DATASETS["customers"].silver))
    kinds = F.array_compact(F.array(F.when(is_active(), "active")))
    written = store.write_split("latest_customers", latest.withColumn(KINDS, kinds), {
        "silver_customers": (["active"], latest.columns)}, bucket_by="customer_id")
    metrics["customers"] |= {"valid_rows": written["rows"], "silver_rows": written["active_rows"]}
    counts["silver_customers"] = written["active_rows"]

    silver = StoredSilver(store, counts, metrics)
    counts[ENRICHED] = store.write(ENRICHED, silver.join_enriched())["rows"]
    return silver


# Marts built from the stored enriched fact (each one scan of its columns).
FACT_MARTS = {
    "agg_category_month_stats": gold.category_month_stats,
    "gold_city_sales": gold.city_sales,
    "gold_customer_value": gold.customer_value,
    "gold_top_products_by_category": gold.top_products_by_category,
    "agg_latest_order_per_customer": gold.latest_order_per_customer,
}
# Marts on the same (month, category) grain, derived from the stored
# category-month stats instead of aggregating the fact again.
MONTH_CATEGORY_MARTS = {
    "gold_monthly_category_sales": lambda stats: stats.select(
        "order_month", "category", "order_count", "total_quantity", "total_revenue",
        "avg_order_value"),
    "agg_running_revenue_by_category": lambda stats: gold.running_total(
        stats.select("category", "order_month",
                     stats["total_revenue"].alias("monthly_revenue")),
        ["category"], "order_month", "monthly_revenue", "running_revenue_total"),
}


def build_gold(silver: StoredSilver) -> dict[str, int]:
    """Every gold / agg table from the *stored* enriched fact; independent
    marts are written concurrently."""
    store, fact = silver.store, silver.enriched
    counts = run_concurrently({name: _write_task(store, name, build(fact))
                               for name, build in FACT_MARTS.items()})
    stats = store.read("agg_category_month_stats")
    counts.update(run_concurrently({
        name: _write_task(store, name, build(stats)) for name, build in MONTH_CATEGORY_MARTS.items()}))
    return counts
