"""Raw extracts derived from the provided TPC-H-style tables.

The pipeline's inputs are three all-string extracts (customers, products,
sales orders). Here they are derived from the ``/root/testdata`` tables with
deterministic dirt injected by key arithmetic (padding, case noise, blanks,
NULLs, bad prices, repeated customer versions), so every cleaning rule has
work to do and the same rows can be rebuilt by an SQL oracle.

Each extract is one scan of its base table: customer versions come from a
single ``explode`` rather than a union of three scans, and the only joins are
to ``nation``/``region`` (25 and 5 rows by the TPC-H definition, so their
broadcast has a fixed size bound) and lineitem -> orders (a key join left to
the planner / AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS

# The provided tables' schemas. Declaring them skips parquet
# footer schema inference on every read (about a quarter second per table
# on the driver here, and a job per read over many files on a cluster).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
               "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The adapter rules as Spark SQL expressions: one ``selectExpr`` per extract
# is one analysis pass instead of hundreds of small Column calls.
CUSTOMER_EXPRS = {
    "customer_id": "CASE WHEN v = 2 THEN CAST(c_custkey AS STRING) "
                   "ELSE concat(' ', CAST(c_custkey AS STRING), ' ') END",
    "customer_name": "CASE WHEN v = 0 THEN concat(' ', lower(c_name)) "
                     "WHEN v = 1 THEN concat(' ', upper(c_name)) "
                     "ELSE concat(lower(c_name), ' jr') END",
    "email": "concat('user', CAST(c_custkey AS STRING), '@example.com ')",
    "city": "CASE WHEN v <> 0 THEN lower(n_name) WHEN c_custkey % 17 = 0 THEN '  ' "
            "WHEN c_custkey % 19 = 0 THEN NULL ELSE lower(n_name) END",
    "state": "lower(n_name)",
    "region": "lower(r_name)",
    "customer_segment": "lower(c_mktsegment)",
    "is_active": "CASE WHEN v = 0 THEN IF(c_acctbal < 0, 'n', ' y ') "
                 "WHEN v = 1 THEN IF(c_custkey % 10 = 0, 'n', 'y') ELSE 'Y' END",
    "signup_date": "date_format(date_add(DATE'2020-01-01', CAST(c_custkey % 365 AS INT)), "
                   "'yyyy-MM-dd')",
    "date_of_birth": "date_format(date_add(DATE'1960-01-01', CAST(c_custkey % 9000 AS INT)), "
                     "'yyyy-MM-dd')",
    "updated_at": "CASE WHEN v = 1 THEN IF(c_custkey % 15 = 0, NULL, '2024-01-02 00:00:00') "
                  "ELSE '2024-01-01 00:00:00' END",
    "loyalty_points": "IF(v = 2, '0', CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS STRING))",
}
# version 0: every customer; 1: k % 5 == 0, one day later; 2: k % 7 == 0, unpadded id
CUSTOMER_VERSIONS = ("explode(array(0, IF(c_custkey % 5 = 0, 1, NULL), "
                     "IF(c_custkey % 7 = 0, 2, NULL))) AS v")

PRODUCT_EXPRS = {
    "product_id": "IF(p_partkey % 11 = 0, concat(' ', CAST(p_partkey AS STRING)), "
                  "CAST(p_partkey AS STRING))",
    "product_name": "IF(p_partkey % 4 = 0, upper(p_name), p_name)",
    "category": "lower(p_type)",
    "subcategory": "lower(p_brand)",
    "supplier_name": "concat('supplier ', CAST(p_partkey % 100 AS STRING))",
    "active_flag": "IF(p_size % 10 = 0, 'n', ' y')",
    "unit_price": "CASE WHEN p_partkey % 23 = 0 THEN 'abc' WHEN p_partkey % 29 = 0 THEN '-1.00' "
                  "ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END",
    "cost_price": "IF(p_partkey % 31 = 0, NULL, CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) "
                  "* CAST(0.8 AS DECIMAL(1,1)) AS DECIMAL(12,2)) AS STRING))",
    "stock_quantity": "CAST(p_size AS STRING)",
    "launch_date": "date_format(date_add(DATE'2015-01-01', CAST(p_partkey % 1000 AS INT)), "
                   "'yyyy-MM-dd')",
    "product_rating": "concat(CAST((p_partkey % 50) DIV 10 AS STRING), '.', "
                      "CAST(p_partkey % 10 AS STRING))",
}

ORDER_EXPRS = {
    "order_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "customer_id": "CAST(o_custkey AS STRING)",
    "product_id": "CAST(l_partkey AS STRING)",
    "payment_method": "lower(o_orderpriority)",
    "order_status": "CASE WHEN l_orderkey % 101 = 0 THEN NULL "
                    "WHEN o_orderstatus = 'F' THEN 'completed' "
                    "WHEN o_orderstatus = 'P' THEN ' pending' "
                    "WHEN l_returnflag = 'R' THEN 'cancelled' "
                    "WHEN l_returnflag = 'A' THEN 'Returned' ELSE 'shipped' END",
    "sales_channel": "CASE l_linenumber % 3 WHEN 0 THEN ' online' WHEN 1 THEN 'store ' "
                     "ELSE 'mobile' END",
    "warehouse_id": "concat('w', CAST(l_suppkey % 7 AS STRING))",
    "order_timestamp": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' ', "
                       "lpad(CAST(l_orderkey % 24 AS STRING), 2, '0'), ':', "
                       "lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':00')",
    "promised_delivery_date": "date_format(date_add(CAST(o_orderdate AS DATE), 30), "
                              "'yyyy-MM-dd')",
    "actual_delivery_date": "IF(l_linestatus = 'O', NULL, date_format(l_shipdate, 'yyyy-MM-dd'))",
    "quantity": "CAST(CAST(l_quantity AS INT) - 2 AS STRING)",
    "discount_pct": "CAST(CAST(round(l_discount * 100) AS INT) AS STRING)",
}


def _project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])


def customers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_*.csv: one row per customer version, every column text.

    version 0: every customer, padded id, ' y ' / 'n' active flag.
    version 1: k % 5 == 0, one day later (NULL time when k % 15 == 0).
    version 2: k % 7 == 0, unpadded id, same time as version 0 (a tie).
    """
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    geo = (read_table(spark, sf_dir, "nation")
           .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    base = (customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr("*", CUSTOMER_VERSIONS)
            .filter("v IS NOT NULL"))
    return _project(base, CUSTOMER_EXPRS).select(*CUSTOMER_COLUMNS)


def products_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products_*.csv: one row per part, prices as text with bad values."""
    part = read_table(spark, sf_dir, "part")
    return _project(part, PRODUCT_EXPRS).select(*PRODUCT_COLUMNS)


def orders_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sales_orders_*.csv: one row per line item, joined to its order."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    j = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _project(j, ORDER_EXPRS).select(*ORDER_COLUMNS)


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers_extract(spark, sf_dir),
        "products": products_extract(spark, sf_dir),
        "sales_orders": orders_extract(spark, sf_dir),
    }


# Malformed values on top of the extracts, for the quarantine.
DAMAGE = {
    "customers": {
        "signup_date": "CASE WHEN email LIKE '%7@%' AND is_active = 'Y' THEN '31/12/2020' "
                       "ELSE signup_date END",
        "loyalty_points": "CASE WHEN email LIKE '%13@%' THEN concat(loyalty_points, '.5') "
                          "ELSE loyalty_points END",
    },
    "products": {
        "launch_date": "CASE WHEN stock_quantity = '13' THEN '2015-02-30' ELSE launch_date END",
    },
    "sales_orders": {
        "order_timestamp": "CASE WHEN order_id LIKE '%77-_' THEN replace(order_timestamp, ' ', 'T') "
                           "ELSE order_timestamp END",
        "quantity": "CASE WHEN order_id LIKE '%5-3' THEN 'many' ELSE quantity END",
        "discount_pct": "CASE WHEN order_id LIKE '%9-2' THEN concat(discount_pct, '%') "
                        "ELSE discount_pct END",
    },
}


def damaged_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The extracts with values a strict parse fails on."""
    return {name: df.withColumns({c: F.expr(e) for c, e in DAMAGE[name].items()})
            for name, df in raw_extracts(spark, sf_dir).items()}


def broken_lines_extract(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land the customers extract as raw lines, some short or long.

    A line is written as it is: one column whose name is the header line, in
    a dialect without quotes and with a separator that no value holds.
    """
    rows = customers_extract(spark, sf_dir)
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in CUSTOMER_COLUMNS])
    line = (F.when(F.col("email").like("%3@%"), F.substring_index(line, ",", 5))
            .when(F.col("email").like("%8@%"), F.concat(line, F.lit(",extra,values")))
            .otherwise(line))
    (rows.select(line.alias(",".join(CUSTOMER_COLUMNS))).write.mode("overwrite")
     .options(header="true", sep="\u0001", quote="\u0000", escape="\u0000",
              ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))
