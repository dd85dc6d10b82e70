"""Explicit schemas for the three raw extracts and the typed silver columns.

Raw extracts are all-string (bronze keeps the source text as-is); types are
fixed by hand in silver. Type inference is never used: it would read the
whole input an extra time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the three extracts.
CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "email", "city", "state", "region",
    "customer_segment", "is_active", "signup_date", "date_of_birth",
    "updated_at", "loyalty_points",
]

PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "supplier_name",
    "active_flag", "unit_price", "cost_price", "stock_quantity", "launch_date",
    "product_rating",
]

ORDER_COLUMNS = [
    "order_id", "customer_id", "product_id", "payment_method", "order_status",
    "sales_channel", "warehouse_id", "order_timestamp",
    "promised_delivery_date", "actual_delivery_date", "quantity", "discount_pct",
]

EXTRACT_COLUMNS = {
    "customers": CUSTOMER_COLUMNS,
    "products": PRODUCT_COLUMNS,
    "sales_orders": ORDER_COLUMNS,
}


def all_string(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# Schemas of the extracts as text.
CUSTOMERS_RAW = all_string(CUSTOMER_COLUMNS)
PRODUCTS_RAW = all_string(PRODUCT_COLUMNS)
ORDERS_RAW = all_string(ORDER_COLUMNS)

# Fixed values shared with the reference pipeline: parse patterns, the
# financial status exclusions, the completed status and the event type.
DATE_PATTERN = "yyyy-MM-dd"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
MONTH_PATTERN = "yyyy-MM"
NON_FINANCIAL_STATUSES = ("PENDING", "CANCELLED")
COMPLETED_STATUS = "COMPLETED"
ACTIVE_FLAG = "Y"
UNKNOWN_CITY = "Unknown"
EVENT_TYPE = "MONTHLY_CATEGORY_SALES_READY"
EVENT_ID_PREFIX = "SALES"

# Typed result of the sales event (one JSON object per gold row).
SALES_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("sales_month", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("order_count", T.LongType(), True),
    T.StructField("total_quantity", T.LongType(), True),
    T.StructField("total_revenue", T.DoubleType(), True),
])
