"""Silver: typed, cleaned, deduplicated tables and the enriched sales fact.

Rules (same as the reference pipeline):

* customers: trim 8 text columns; title-case name, state, segment, city
  (blank/NULL city -> 'Unknown'); upper-case region and the active flag;
  parse dates / timestamp / loyalty points; keep the latest version per
  trimmed ``customer_id``, *then* keep active ('Y') customers -- a customer
  whose latest version is inactive disappears.
* products: trim 6; title-case name, category, subcategory, supplier;
  upper-case the flag; prices via safe decimal cast; keep rows with both
  prices present and > 0, then active ones. Not deduplicated.
* orders: trim 7; parse; upper-case codes; keep quantity > 0 (all statuses);
  the financial subset drops PENDING and CANCELLED (a NULL status is dropped
  too, since ``NOT (NULL IN ...)`` is NULL).
* enriched: financial orders x products (product_id) x customers
  (customer_id), inner joins, 30 columns with derived money and delivery.

Bronze keeps an empty string apart from NULL; the cleaning rules, like the
reference's CSV reader, take it as NULL. Extra input columns (e.g. bronze lineage) pass through the cleaning steps.
Joins carry no hints: AQE broadcasts a dimension only when its runtime size
is under the threshold. Over stored silver tables (``plans.medallion``) both
join inputs are fresh shuffles and AQE splits a skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleaning import (blank_to_default, cast_col, empty_to_null, safe_decimal,
                                           to_date_col, to_timestamp_col, trim_columns)
from ledgerlake.functions.money import (discount_amount, gross_amount, net_amount,
                                        unit_profit)
from ledgerlake.operators.latest import keep_latest
from ledgerlake.schemas import (ACTIVE_FLAG, CUSTOMER_COLUMNS, MONTH_PATTERN,
                                NON_FINANCIAL_STATUSES, ORDER_COLUMNS, PRODUCT_COLUMNS)

# The text columns each dataset trims.
CUSTOMER_TRIM = ["customer_id", "customer_name", "email", "city", "state", "region",
                 "customer_segment", "is_active"]
PRODUCT_TRIM = ["product_id", "product_name", "category", "subcategory", "supplier_name",
                "active_flag"]
ORDER_TRIM = ["order_id", "customer_id", "product_id", "payment_method", "order_status",
              "sales_channel", "warehouse_id"]


# ---------------------------------------------------------------- customers
def type_customers(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    df = trim_columns(empty_to_null(bronze, CUSTOMER_COLUMNS), CUSTOMER_TRIM)
    return df.withColumns({
        "customer_name": F.initcap("customer_name"),
        "city": blank_to_default("city"),
        "state": F.initcap("state"),
        "region": F.upper("region"),
        "customer_segment": F.initcap("customer_segment"),
        "is_active": F.upper("is_active"),
        "signup_date": to_date_col("signup_date", on_bad),
        "date_of_birth": to_date_col("date_of_birth", on_bad),
        "updated_at": to_timestamp_col("updated_at", on_bad),
        "loyalty_points": cast_col("loyalty_points", "int", on_bad),
    })


# Columns that order the versions of a customer, latest first: updated_at
# (NULLs last), ties by the typed columns in extract order, so the pick is
# reproducible.
CUSTOMER_VERSION_ORDER = ["updated_at", *[c for c in CUSTOMER_COLUMNS
                                          if c not in ("customer_id", "updated_at")]]


def dedup_customers(typed: DataFrame) -> DataFrame:
    """Latest version per customer_id."""
    return keep_latest(typed, ["customer_id"], CUSTOMER_VERSION_ORDER[:1],
                       tie_break=CUSTOMER_VERSION_ORDER[1:])


def is_active():
    return F.col("is_active") == ACTIVE_FLAG


def clean_customers(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """silver_customers."""
    latest = dedup_customers(type_customers(bronze, on_bad))
    return latest.filter(is_active())


# ----------------------------------------------------------------- products
def type_products(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    df = trim_columns(empty_to_null(bronze, PRODUCT_COLUMNS), PRODUCT_TRIM)
    return df.withColumns({
        "product_name": F.initcap("product_name"),
        "category": F.initcap("category"),
        "subcategory": F.initcap("subcategory"),
        "supplier_name": F.initcap("supplier_name"),
        "active_flag": F.upper("active_flag"),
        "unit_price": safe_decimal("unit_price"),
        "cost_price": safe_decimal("cost_price"),
        "stock_quantity": cast_col("stock_quantity", "int", on_bad),
        "launch_date": to_date_col("launch_date", on_bad),
        "product_rating": cast_col("product_rating", "double", on_bad),
    })


def has_valid_price():
    """F2 as a column: both prices present and positive."""
    up, cp = F.col("unit_price"), F.col("cost_price")
    return up.isNotNull() & (up > 0) & cp.isNotNull() & (cp > 0)


def valid_price(typed: DataFrame) -> DataFrame:
    return typed.filter(has_valid_price())


def clean_products(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """silver_products."""
    return valid_price(type_products(bronze, on_bad)).filter(F.col("active_flag") == ACTIVE_FLAG)


# ------------------------------------------------------------------- orders
def type_orders(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    df = trim_columns(empty_to_null(bronze, ORDER_COLUMNS), ORDER_TRIM)
    return df.withColumns({
        "order_timestamp": to_timestamp_col("order_timestamp", on_bad),
        "promised_delivery_date": to_date_col("promised_delivery_date", on_bad),
        "actual_delivery_date": to_date_col("actual_delivery_date", on_bad),
        "quantity": cast_col("quantity", "int", on_bad),
        "discount_pct": cast_col("discount_pct", "decimal(5,2)", on_bad),
        "payment_method": F.upper("payment_method"),
        "order_status": F.upper("order_status"),
        "sales_channel": F.upper("sales_channel"),
        "warehouse_id": F.upper("warehouse_id"),
    })


def has_quantity():
    return F.col("quantity") > 0


def is_financial():
    """Neither PENDING nor CANCELLED (NULL status: NULL, so filters drop it)."""
    return ~F.col("order_status").isin(*NON_FINANCIAL_STATUSES)


def clean_orders(bronze: DataFrame, on_bad: str = "fail") -> DataFrame:
    """silver_orders (quantity > 0, every status)."""
    return type_orders(bronze, on_bad).filter(has_quantity())


def financial_orders(silver_orders: DataFrame) -> DataFrame:
    """Drop PENDING and CANCELLED (and NULL status)."""
    return silver_orders.filter(is_financial())


# ----------------------------------------------------------------- enriched
def enrich(orders_fin: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """silver_sales_enriched.

    Inner joins on customer_id and product_id (join order does not change an
    inner join's result). Over the stored tables both sides of each join are
    fresh shuffles, where AQE splits a hot customer or product.
    """
    o, p, c = orders_fin.alias("o"), products.alias("p"), customers.alias("c")
    j = o.join(c, on="customer_id", how="inner").join(p, on="product_id", how="inner")
    gross = gross_amount(F.col("o.quantity"), F.col("p.unit_price"))
    disc = discount_amount(gross, F.col("o.discount_pct"))
    net = net_amount(gross, disc)
    actual, promised = F.col("o.actual_delivery_date"), F.col("o.promised_delivery_date")
    return j.select(
        F.col("o.order_id"), F.col("o.order_timestamp"),
        F.date_format(F.col("o.order_timestamp"), MONTH_PATTERN).alias("order_month"),
        F.col("o.customer_id"), F.col("c.customer_name"), F.col("c.city"), F.col("c.state"),
        F.col("c.region"), F.col("c.customer_segment"),
        F.col("o.product_id"), F.col("p.product_name"), F.col("p.category"),
        F.col("p.subcategory"),
        F.col("o.quantity"), F.col("p.unit_price"), F.col("p.cost_price"),
        F.col("o.discount_pct"),
        gross.alias("gross_amount"), disc.alias("discount_amount"),
        net.alias("net_amount"), net.alias("net_sales"),
        unit_profit(F.col("p.unit_price"), F.col("p.cost_price")).alias("profit_per_unit"),
        promised.alias("promised_delivery_date"), actual.alias("actual_delivery_date"),
        F.datediff(actual, promised).alias("delivery_days"),
        F.when(actual > promised, F.lit("Y")).otherwise(F.lit("N")).alias("late_delivery_flag"),
        F.col("o.order_status"), F.col("o.payment_method"), F.col("o.sales_channel"),
        F.col("o.warehouse_id"),
    )
