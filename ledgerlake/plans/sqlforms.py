"""The same questions written as Spark SQL text (D19-D22) and their checks.

Views are registered with ``createOrReplaceTempView`` under caller-chosen
names (K3). Statements take their input names as ``IDENTIFIER(:name)``
parameters (P34; bound by Spark, never pasted into the text), so nothing
depends on the current catalog and any view or ``catalog.schema.table``
name can be passed. Catalyst inlines the views, so a SQL form
and its DataFrame twin compile to the same kind of plan.

Two definitions differ on purpose and are never treated as equal:
the SQL form keeps only COMPLETED orders and rounds net amount once; the
DataFrame form drops PENDING/CANCELLED and rounds the discount first.
``definition_gap`` reports that difference per month and category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.money import sql_net_amount_expr
from ledgerlake.operators.diff import compare_counts, keyed_diff
from ledgerlake.operators.measures import grouped_select
from ledgerlake.schemas import COMPLETED_STATUS, MONTH_PATTERN


def register(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def completed_orders_joined(spark: SparkSession, orders: str = "silver_orders",
                            customers: str = "silver_customers",
                            products: str = "silver_products") -> DataFrame:
    """COMPLETED orders x customers x products with the SQL net amount."""
    net = sql_net_amount_expr("quantity", "unit_price", "discount_pct")
    return spark.sql(
        "WITH done AS (SELECT * FROM IDENTIFIER(:orders) WHERE order_status = :status), "
        "items AS (SELECT product_id, product_name, initcap(category) AS category, unit_price"
        " FROM IDENTIFIER(:products)), "
        "buyers AS (SELECT customer_id, customer_name, state, customer_segment"
        " FROM IDENTIFIER(:customers)) "
        "SELECT order_id, customer_id, customer_name, product_id, product_name,"
        f" date_format(order_timestamp, '{MONTH_PATTERN}') AS order_month, quantity,"
        f" {net} AS net_amount, state, customer_segment, category "
        "FROM done JOIN items USING (product_id) JOIN buyers USING (customer_id)",
        args={"orders": orders, "customers": customers, "products": products,
              "status": COMPLETED_STATUS})


def _grouped(spark: SparkSession, view: str, keys: list[str], measures: dict[str, str],
             amount: str) -> DataFrame:
    return spark.sql(grouped_select(keys, measures, amount), args={"source": view})


def _ranked(df: DataFrame, function: str, group: str, by: str, name: str, n: int) -> DataFrame:
    """Rows whose ``function()`` by falling ``by`` inside ``group`` is at most ``n``."""
    place = f"{function}() OVER (PARTITION BY {group} ORDER BY {by} DESC) AS {name}"
    return df.selectExpr("*", place).filter(f"{name} <= {int(n)}")


def monthly_summary(spark: SparkSession, view: str = "completed_orders_joined") -> DataFrame:
    """``total_quantity`` counts rows here (A10); ``total_units`` is the
    real unit sum."""
    own = {"order_count": "order_count", "total_quantity": "quantity_rows"}
    same = ["total_units", "total_revenue", "avg_order_value", "min_order_value",
            "max_order_value"]
    return _grouped(spark, view, ["order_month", "category"], {**own, **{m: m for m in same}},
                    "net_amount")


def product_rank(spark: SparkSession, view: str = "completed_orders_joined",
                 n: int = 5) -> DataFrame:
    """Product revenue per category, rank with gaps, cut at n."""
    sales = _grouped(spark, view, ["category", "product_id", "product_name"],
                     {m: m for m in ("total_quantity", "total_revenue")}, "net_amount")
    return _ranked(sales, "rank", "category", "total_revenue", "revenue_rank", n)


def top_customers(spark: SparkSession, customer_value_view: str = "gold_customer_value",
                  n: int = 3) -> DataFrame:
    """Dense rank of lifetime revenue within state, cut at n."""
    value = spark.sql("SELECT * FROM IDENTIFIER(:source)", args={"source": customer_value_view})
    return _ranked(value, "dense_rank", "state", "lifetime_revenue", "customer_rank", n)


def category_month_stats_sql(spark: SparkSession, enriched_view: str = "silver_sales_enriched"
                             ) -> DataFrame:
    """The DataFrame definition of D13 as a statement (for the parity check)."""
    measures = ["order_count", "total_quantity", "total_revenue", "avg_order_value",
                "min_order_value", "max_order_value"]
    return _grouped(spark, enriched_view, ["order_month", "category"], {m: m for m in measures},
                    "net_sales")


def sql_vs_api_diff(api: DataFrame, sql: DataFrame) -> DataFrame:
    """Q4: rows of each side, rows that match, rows on one side only."""
    return compare_counts(api, sql.select(*api.columns), "api", "sql")


def sql_vs_api_cells(api_stats: DataFrame, sql_summary: DataFrame) -> DataFrame:
    """Q4, cell by cell: where the SQL monthly summary and the DataFrame marts
    (two definitions, see above) show different values for a month and category."""
    keys = ["order_month", "category"]
    sql = sql_summary.withColumn("total_quantity", F.col("total_units")).drop("total_units")
    return keyed_diff(api_stats, sql, keys, [c for c in api_stats.columns if c not in keys])


def definition_gap(api_stats: DataFrame, sql_summary: DataFrame) -> DataFrame:
    """Order count and revenue per month/category under the two definitions.

    A union + one group-by instead of a full outer join: one shuffle, and a
    key present on one side only still gets a row (the other side 0).
    """
    keys = ["order_month", "category"]
    zero_rev = F.lit(0).cast("decimal(24,2)")
    a = api_stats.select(*keys,
                         F.col("order_count").cast("bigint").alias("api_order_count"),
                         F.lit(0).cast("bigint").alias("sql_order_count"),
                         F.col("total_revenue").cast("decimal(24,2)").alias("api_revenue"),
                         zero_rev.alias("sql_revenue"))
    s = sql_summary.select(*keys,
                           F.lit(0).cast("bigint").alias("api_order_count"),
                           F.col("order_count").cast("bigint").alias("sql_order_count"),
                           zero_rev.alias("api_revenue"),
                           F.col("total_revenue").cast("decimal(24,2)").alias("sql_revenue"))
    g = a.unionByName(s).groupBy(*keys).agg(
        F.sum("api_order_count").alias("api_order_count"),
        F.sum("sql_order_count").alias("sql_order_count"),
        F.coalesce(F.sum("api_revenue"), zero_rev).cast("decimal(24,2)").alias("api_revenue"),
        F.coalesce(F.sum("sql_revenue"), zero_rev).cast("decimal(24,2)").alias("sql_revenue"),
    )
    return g.select(
        *keys, "api_order_count", "sql_order_count",
        (F.col("api_order_count") - F.col("sql_order_count")).cast("bigint").alias("order_count_gap"),
        "api_revenue", "sql_revenue",
        (F.col("api_revenue") - F.col("sql_revenue")).cast("decimal(25,2)").alias("revenue_gap"),
    )
