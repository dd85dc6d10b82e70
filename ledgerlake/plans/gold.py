"""Gold marts and window results over the enriched sales fact.

The builders apply no global ``orderBy``: a frame has no row order. Tables that
are shown sorted are stored in that order (``SHOWN_ORDER``, ``operators.ordered``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.latest import keep_latest
from ledgerlake.operators.measures import group_measures
from ledgerlake.operators.rank import rank_within_groups
from ledgerlake.operators.running import running_total
from ledgerlake.operators.topk import top_n_per_group
from ledgerlake.functions.cleaning import to_timestamp_col

TOP_PRODUCTS = 5
TOP_CUSTOMERS = 3


def monthly_category_sales(enriched: DataFrame, extremes: bool = False) -> DataFrame:
    """D9 (gold_monthly_category_sales); ``extremes=True`` gives D13."""
    m = ["order_count", "total_quantity", "total_revenue", "avg_order_value"]
    if extremes:
        m += ["min_order_value", "max_order_value"]
    return group_measures(enriched, ["order_month", "category"], m)


def category_month_stats(enriched: DataFrame) -> DataFrame:
    """D13 (agg_category_month_stats)."""
    return monthly_category_sales(enriched, extremes=True)


def city_sales(enriched: DataFrame) -> DataFrame:
    """D10 (gold_city_sales)."""
    return group_measures(enriched, ["city", "state", "region"],
                          ["order_count", "total_quantity", "total_revenue"])


def customer_value(enriched: DataFrame) -> DataFrame:
    """D11 (gold_customer_value)."""
    return group_measures(enriched, ["customer_id", "customer_name", "customer_segment", "state"],
                          ["order_count", "lifetime_revenue", "avg_order_value", "last_order_at"])


def product_sales(enriched: DataFrame) -> DataFrame:
    return group_measures(enriched, ["category", "product_id", "product_name"],
                          ["total_quantity", "total_revenue"])


def top_products_by_category(enriched: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """D12 (gold_top_products_by_category): rank() <= n, ties kept."""
    return top_n_per_group(product_sales(enriched), ["category"], "total_revenue", n,
                           "revenue_rank", "rank")


def product_rank_all(enriched: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every product with its revenue rank in its category.

    Categories are few and huge, so the rank is computed with the
    bucketed distributed rank instead of one window task per category.
    """
    return rank_within_groups(product_sales(enriched), ["category"], "total_revenue",
                              "revenue_rank", "rank", buckets)


def customers_ranked_in_state(customer_value_df: DataFrame, n: int = TOP_CUSTOMERS,
                              rank_col: str = "state_rank") -> DataFrame:
    """dense_rank() of lifetime revenue within state, cut at n."""
    return top_n_per_group(customer_value_df, ["state"], "lifetime_revenue", n, rank_col,
                           "dense_rank")


def running_revenue(enriched: DataFrame) -> DataFrame:
    """D17 (agg_running_revenue_by_category): month totals, then running sum."""
    monthly = group_measures(enriched, ["category", "order_month"], ["monthly_revenue"])
    return running_total(monthly, ["category"], "order_month", "monthly_revenue",
                         "running_revenue_total")


LATEST_ORDER_COLUMNS = ["customer_id", "customer_name", "order_id", "order_timestamp",
                        "product_name", "category", "net_sales", "order_status"]


def latest_order_per_customer(enriched: DataFrame) -> DataFrame:
    """D18 (agg_latest_order_per_customer): newest order row per customer.

    Ties on the timestamp (all lines of an order share it) are broken by
    order_id and then the remaining output columns, all descending.
    """
    slim = enriched.select(*LATEST_ORDER_COLUMNS)
    return keep_latest(slim, ["customer_id"], ["order_timestamp"],
                       tie_break=["order_id", "net_sales", "product_name", "category",
                                  "order_status", "customer_name"])


def latest_customer_profile(customers_bronze: DataFrame) -> DataFrame:
    """Newest raw (bronze) row per *untrimmed* customer_id, active or not.

    Ordered by the parsed ``updated_at`` (NULLs last); ties broken by the raw
    columns descending. Output keeps the bronze columns as text.
    """
    ts = "__updated_at_ts"
    df = customers_bronze.withColumn(ts, to_timestamp_col("updated_at"))
    rest = [c for c in customers_bronze.columns if c != "customer_id"]
    return keep_latest(df, ["customer_id"], [ts], tie_break=rest).drop(ts)


# O1-O3: the order in which each result is shown.
SHOWN_ORDER = {
    "status_distribution": ["order_status"],
    "gold_monthly_category_sales": ["order_month", "category"],
    "gold_city_sales": ["total_revenue desc"],
    "gold_customer_value": ["lifetime_revenue desc"],
}


def preview(df: DataFrame, n: int = 5) -> list[str]:
    """K7 + O4: the first ``n`` rows as JSON lines (``n`` rows reach the
    driver; a scan stops after them)."""
    return [r[0] for r in df.limit(n).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]


__all__ = [
    "monthly_category_sales", "category_month_stats", "city_sales", "customer_value",
    "product_sales", "top_products_by_category", "product_rank_all",
    "customers_ranked_in_state", "running_revenue", "latest_order_per_customer",
    "latest_customer_profile", "preview", "running_total", "SHOWN_ORDER",
]
