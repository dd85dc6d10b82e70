"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL rebuilds the whole pipeline from the provided tables -- raw extracts,
cleaning, dedup, joins, marts -- without sharing code with the Spark side.
DuckDB differences handled here:

* no ``initcap``: split on single spaces, upper the first character of each
  piece, rejoin (Spark only treats the space character as a word break);
* decimal ``/`` and ``avg`` give DOUBLE: multiply by 0.01 instead of
  dividing by 100, and rebuild Spark's ``round(avg(x), 2)`` (avg rounded
  half-up to 6 places, then to 2) in integer cents;
* ``sum`` widens to HUGEINT / DECIMAL(38,s): cast back to Spark's types.
"""

from __future__ import annotations


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _half_up_div(p: str, q: str) -> str:
    """Integer p / q (q > 0) rounded half away from zero."""
    return f"(sign({p}) * ((2 * abs({p}) + {q}) // (2 * {q})))"


def spark_round_avg(x: str) -> str:
    """``round(avg(x), 2)`` for a decimal(p,2) column, exactly as Spark does."""
    cents = f"SUM(CAST({x} * 100 AS BIGINT))"
    n = f"COUNT({x})"
    micros = _half_up_div(f"({cents} * 10000)", n)
    out_cents = _half_up_div(micros, "10000")
    return f"CAST(CAST({out_cents} AS DECIMAL(36,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2))"


def _ts(x: str) -> str:
    return f"strptime({x}, '%Y-%m-%d %H:%M:%S')"


def _d(x: str) -> str:
    return f"CAST(strptime({x}, '%Y-%m-%d') AS DATE)"


def _t(x: str) -> str:
    return f"trim({x}, ' ')"


RAW_CUSTOMERS = """
cust_base AS (
    SELECT c.c_custkey AS k, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
cust_versions AS (
    SELECT *, 0 AS v FROM cust_base
    UNION ALL SELECT *, 1 AS v FROM cust_base WHERE k % 5 = 0
    UNION ALL SELECT *, 2 AS v FROM cust_base WHERE k % 7 = 0
),
raw_customers AS (
    SELECT
        CASE WHEN v = 2 THEN CAST(k AS VARCHAR) ELSE ' ' || CAST(k AS VARCHAR) || ' ' END AS customer_id,
        CASE WHEN v = 0 THEN ' ' || lower(c_name) WHEN v = 1 THEN ' ' || upper(c_name)
             ELSE lower(c_name) || ' jr' END AS customer_name,
        'user' || CAST(k AS VARCHAR) || '@example.com ' AS email,
        CASE WHEN v <> 0 THEN lower(n_name) WHEN k % 17 = 0 THEN '  '
             WHEN k % 19 = 0 THEN NULL ELSE lower(n_name) END AS city,
        lower(n_name) AS state,
        lower(r_name) AS region,
        lower(c_mktsegment) AS customer_segment,
        CASE WHEN v = 0 THEN (CASE WHEN c_acctbal < 0 THEN 'n' ELSE ' y ' END)
             WHEN v = 1 THEN (CASE WHEN k % 10 = 0 THEN 'n' ELSE 'y' END)
             ELSE 'Y' END AS is_active,
        strftime(DATE '2020-01-01' + CAST(k % 365 AS INTEGER), '%Y-%m-%d') AS signup_date,
        strftime(DATE '1960-01-01' + CAST(k % 9000 AS INTEGER), '%Y-%m-%d') AS date_of_birth,
        CASE WHEN v = 1 THEN (CASE WHEN k % 15 = 0 THEN NULL ELSE '2024-01-02 00:00:00' END)
             ELSE '2024-01-01 00:00:00' END AS updated_at,
        CASE WHEN v = 2 THEN '0' ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) END
            AS loyalty_points
    FROM cust_versions
)"""

RAW_PRODUCTS = """
raw_products AS (
    SELECT
        CASE WHEN p_partkey % 11 = 0 THEN ' ' || CAST(p_partkey AS VARCHAR)
             ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
        CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END AS product_name,
        lower(p_type) AS category,
        lower(p_brand) AS subcategory,
        'supplier ' || CAST(p_partkey % 100 AS VARCHAR) AS supplier_name,
        CASE WHEN p_size % 10 = 0 THEN 'n' ELSE ' y' END AS active_flag,
        CASE WHEN p_partkey % 23 = 0 THEN 'abc' WHEN p_partkey % 29 = 0 THEN '-1.00'
             ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
        CASE WHEN p_partkey % 31 = 0 THEN NULL
             ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.8 AS DECIMAL(1,1))
                            AS DECIMAL(12,2)) AS VARCHAR) END AS cost_price,
        CAST(p_size AS VARCHAR) AS stock_quantity,
        strftime(DATE '2015-01-01' + CAST(p_partkey % 1000 AS INTEGER), '%Y-%m-%d') AS launch_date,
        CAST((p_partkey % 50) // 10 AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR)
            AS product_rating
    FROM part
)"""

RAW_ORDERS = """
raw_orders AS (
    SELECT
        CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
        CAST(o_custkey AS VARCHAR) AS customer_id,
        CAST(l_partkey AS VARCHAR) AS product_id,
        lower(o_orderpriority) AS payment_method,
        CASE WHEN l_orderkey % 101 = 0 THEN NULL
             WHEN o_orderstatus = 'F' THEN 'completed'
             WHEN o_orderstatus = 'P' THEN ' pending'
             WHEN l_returnflag = 'R' THEN 'cancelled'
             WHEN l_returnflag = 'A' THEN 'Returned'
             ELSE 'shipped' END AS order_status,
        CASE WHEN l_linenumber % 3 = 0 THEN ' online' WHEN l_linenumber % 3 = 1 THEN 'store '
             ELSE 'mobile' END AS sales_channel,
        'w' || CAST(l_suppkey % 7 AS VARCHAR) AS warehouse_id,
        strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0')
            || ':' || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') || ':00' AS order_timestamp,
        strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS promised_delivery_date,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END
            AS actual_delivery_date,
        CAST(CAST(l_quantity AS INTEGER) - 2 AS VARCHAR) AS quantity,
        CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS discount_pct
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

CUSTOMER_TIE = ["customer_name", "email", "city", "state", "region", "customer_segment",
                "is_active", "signup_date", "date_of_birth", "loyalty_points"]

SILVER = f"""
typed_customers AS (
    SELECT
        {_t('customer_id')} AS customer_id,
        {initcap(_t('customer_name'))} AS customer_name,
        {_t('email')} AS email,
        CASE WHEN {_t('city')} = '' OR city IS NULL THEN 'Unknown' ELSE {initcap(_t('city'))} END AS city,
        {initcap(_t('state'))} AS state,
        upper({_t('region')}) AS region,
        {initcap(_t('customer_segment'))} AS customer_segment,
        upper({_t('is_active')}) AS is_active,
        {_d('signup_date')} AS signup_date,
        {_d('date_of_birth')} AS date_of_birth,
        {_ts('updated_at')} AS updated_at,
        CAST(loyalty_points AS INTEGER) AS loyalty_points
    FROM raw_customers
),
dedup_customers AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
            {', '.join(c + ' DESC NULLS LAST' for c in CUSTOMER_TIE)}) AS rn
        FROM typed_customers) WHERE rn = 1
),
silver_customers AS (SELECT * FROM dedup_customers WHERE is_active = 'Y'),
typed_products AS (
    SELECT
        {_t('product_id')} AS product_id,
        {initcap(_t('product_name'))} AS product_name,
        {initcap(_t('category'))} AS category,
        {initcap(_t('subcategory'))} AS subcategory,
        {initcap(_t('supplier_name'))} AS supplier_name,
        upper({_t('active_flag')}) AS active_flag,
        TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
        TRY_CAST(cost_price AS DECIMAL(12,2)) AS cost_price,
        CAST(stock_quantity AS INTEGER) AS stock_quantity,
        {_d('launch_date')} AS launch_date,
        CAST(product_rating AS DOUBLE) AS product_rating
    FROM raw_products
),
valid_products AS (
    SELECT * FROM typed_products
    WHERE unit_price IS NOT NULL AND unit_price > 0 AND cost_price IS NOT NULL AND cost_price > 0
),
silver_products AS (SELECT * FROM valid_products WHERE active_flag = 'Y'),
typed_orders AS (
    SELECT
        {_t('order_id')} AS order_id,
        {_t('customer_id')} AS customer_id,
        {_t('product_id')} AS product_id,
        upper({_t('payment_method')}) AS payment_method,
        upper({_t('order_status')}) AS order_status,
        upper({_t('sales_channel')}) AS sales_channel,
        upper({_t('warehouse_id')}) AS warehouse_id,
        {_ts('order_timestamp')} AS order_timestamp,
        {_d('promised_delivery_date')} AS promised_delivery_date,
        {_d('actual_delivery_date')} AS actual_delivery_date,
        CAST(quantity AS INTEGER) AS quantity,
        CAST(discount_pct AS DECIMAL(5,2)) AS discount_pct
    FROM raw_orders
),
silver_orders AS (SELECT * FROM typed_orders WHERE quantity > 0),
financial_orders AS (
    SELECT * FROM silver_orders WHERE NOT (order_status IN ('PENDING', 'CANCELLED'))
),
enriched_base AS (
    SELECT o.*, p.product_name, p.category, p.subcategory, p.unit_price, p.cost_price,
           c.customer_name, c.city, c.state, c.region, c.customer_segment,
           CAST(o.quantity * p.unit_price AS DECIMAL(14,2)) AS gross_amount
    FROM financial_orders o
    JOIN silver_products p ON o.product_id = p.product_id
    JOIN silver_customers c ON o.customer_id = c.customer_id
),
enriched_disc AS (
    SELECT *, CAST(gross_amount * (discount_pct * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(14,2))
        AS discount_amount
    FROM enriched_base
),
enriched AS (
    SELECT
        order_id, order_timestamp, strftime(order_timestamp, '%Y-%m') AS order_month,
        customer_id, customer_name, city, state, region, customer_segment,
        product_id, product_name, category, subcategory,
        quantity, unit_price, cost_price, discount_pct,
        gross_amount, discount_amount,
        CAST(gross_amount - discount_amount AS DECIMAL(14,2)) AS net_amount,
        CAST(gross_amount - discount_amount AS DECIMAL(14,2)) AS net_sales,
        CAST(unit_price - cost_price AS DECIMAL(12,2)) AS profit_per_unit,
        promised_delivery_date, actual_delivery_date,
        CAST(date_diff('day', promised_delivery_date, actual_delivery_date) AS INTEGER) AS delivery_days,
        CASE WHEN actual_delivery_date > promised_delivery_date THEN 'Y' ELSE 'N' END
            AS late_delivery_flag,
        order_status, payment_method, sales_channel, warehouse_id
    FROM enriched_disc
)"""

PREFIX = "WITH " + ",".join([RAW_CUSTOMERS, RAW_PRODUCTS, RAW_ORDERS, SILVER])


def _with(*ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return PREFIX + extra


def _dec24(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(24,2))"


MONTHLY = f"""
monthly AS (
    SELECT order_month, category,
        COUNT(order_id) AS order_count,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        {_dec24('net_sales')} AS total_revenue,
        {spark_round_avg('net_sales')} AS avg_order_value,
        MIN(net_sales) AS min_order_value,
        MAX(net_sales) AS max_order_value
    FROM enriched GROUP BY order_month, category
)"""

CUSTOMER_VALUE = f"""
customer_value AS (
    SELECT customer_id, customer_name, customer_segment, state,
        COUNT(order_id) AS order_count,
        {_dec24('net_sales')} AS lifetime_revenue,
        {spark_round_avg('net_sales')} AS avg_order_value,
        MAX(order_timestamp) AS last_order_at
    FROM enriched GROUP BY customer_id, customer_name, customer_segment, state
)"""

PRODUCT_SALES = f"""
product_sales AS (
    SELECT category, product_id, product_name,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        {_dec24('net_sales')} AS total_revenue
    FROM enriched GROUP BY category, product_id, product_name
)"""

COMPLETED = """
completed_orders_joined AS (
    SELECT o.order_id, o.customer_id, c.customer_name, o.product_id, p.product_name,
        strftime(o.order_timestamp, '%Y-%m') AS order_month,
        o.quantity,
        CAST(o.quantity * p.unit_price * (1 - o.discount_pct * CAST(0.01 AS DECIMAL(3,2)))
             AS DECIMAL(14,2)) AS net_amount,
        c.state, c.customer_segment, p.category
    FROM silver_orders o
    JOIN silver_customers c ON o.customer_id = c.customer_id
    JOIN silver_products p ON o.product_id = p.product_id
    WHERE o.order_status = 'COMPLETED'
)"""

SQL_MONTHLY = f"""
sql_monthly AS (
    SELECT order_month, category,
        COUNT(order_id) AS order_count,
        COUNT(quantity) AS total_quantity,
        CAST(SUM(quantity) AS BIGINT) AS total_units,
        {_dec24('net_amount')} AS total_revenue,
        {spark_round_avg('net_amount')} AS avg_order_value,
        MIN(net_amount) AS min_order_value,
        MAX(net_amount) AS max_order_value
    FROM completed_orders_joined GROUP BY order_month, category
)"""

EVENTS = """
sales_events AS (
    SELECT 'SALES-' || order_month || '-' || category AS event_id,
        'MONTHLY_CATEGORY_SALES_READY' AS event_type,
        order_month AS sales_month, category, order_count, total_quantity,
        CAST(total_revenue AS DOUBLE) AS total_revenue
    FROM monthly
)"""

ENRICHED_COLS = ("order_id, order_timestamp, order_month, customer_id, customer_name, city, "
                 "state, region, customer_segment, product_id, product_name, category, "
                 "subcategory, quantity, unit_price, cost_price, discount_pct, gross_amount, "
                 "discount_amount, net_amount, net_sales, profit_per_unit, "
                 "promised_delivery_date, actual_delivery_date, delivery_days, "
                 "late_delivery_flag, order_status, payment_method, sales_channel, warehouse_id")

RAW_CUSTOMER_ORDER = ", ".join(
    c + " DESC NULLS LAST" for c in
    ["customer_name", "email", "city", "state", "region", "customer_segment", "is_active",
     "signup_date", "date_of_birth", "updated_at", "loyalty_points"])


CUSTOMER_FIELDS = ["customer_id", "customer_name", "email", "city", "state", "region",
                   "customer_segment", "is_active", "signup_date", "date_of_birth", "updated_at",
                   "loyalty_points"]


def _parsed(c: str, kind: str) -> str:
    """A text column parsed as the silver rules do; what can't be parsed is NULL."""
    if kind == "date":
        return f"try_strptime({c}, '%Y-%m-%d')"
    if kind == "timestamp":
        return f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"
    if kind == "INTEGER":  # DuckDB would round 7.5
        return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST({c} AS INTEGER) END"
    return f"TRY_CAST({c} AS {kind})"


def _damaged() -> str:
    """The common part over extracts that hold malformed values; rows whose
    values can't be parsed stay out of the casts' way through NULL."""
    out = PREFIX
    for table, columns in {
        "raw_customers": {
            "signup_date": "CASE WHEN email LIKE '%7@%' AND is_active = 'Y' THEN '31/12/2020' "
                           "ELSE signup_date END",
            "loyalty_points": "CASE WHEN email LIKE '%13@%' THEN loyalty_points || '.5' "
                              "ELSE loyalty_points END"},
        "raw_products": {
            "launch_date": "CASE WHEN stock_quantity = '13' THEN '2015-02-30' ELSE launch_date END"},
        "raw_orders": {
            "order_timestamp": "CASE WHEN order_id LIKE '%77-_' THEN replace(order_timestamp, ' ', 'T') "
                               "ELSE order_timestamp END",
            "quantity": "CASE WHEN order_id LIKE '%5-3' THEN 'many' ELSE quantity END",
            "discount_pct": "CASE WHEN order_id LIKE '%9-2' THEN discount_pct || '%' "
                            "ELSE discount_pct END"},
    }.items():
        changed = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        out = out.replace(f"{table} AS (", f"whole_{table} AS (", 1)
        out = out.replace("\ntyped_customers AS (",
                          f"\n{table} AS (SELECT * REPLACE ({changed}) FROM whole_{table}),"
                          "\ntyped_customers AS (", 1)
    return out


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_customers"] = _with() + " SELECT * FROM silver_customers"
    q["clean_products"] = _with() + " SELECT * FROM silver_products"
    q["clean_orders"] = _with() + " SELECT * FROM silver_orders"
    q["financial_orders"] = _with() + " SELECT * FROM financial_orders"
    q["sales_enriched"] = _with() + f" SELECT {ENRICHED_COLS} FROM enriched"
    q["monthly_category_sales"] = _with(MONTHLY) + (
        " SELECT order_month, category, order_count, total_quantity, total_revenue, "
        "avg_order_value FROM monthly")
    q["category_month_stats"] = _with(MONTHLY) + " SELECT * FROM monthly"
    q["city_sales"] = _with() + f"""
        SELECT city, state, region, COUNT(order_id) AS order_count,
            CAST(SUM(quantity) AS BIGINT) AS total_quantity, {_dec24('net_sales')} AS total_revenue
        FROM enriched GROUP BY city, state, region"""
    q["customer_value"] = _with(CUSTOMER_VALUE) + " SELECT * FROM customer_value"
    q["top_products_by_category"] = _with(PRODUCT_SALES) + """
        SELECT * FROM (SELECT *, CAST(RANK() OVER (PARTITION BY category
            ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank FROM product_sales)
        WHERE revenue_rank <= 5"""
    q["product_rank_all"] = _with(PRODUCT_SALES) + """
        SELECT *, CAST(RANK() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST)
            AS INTEGER) AS revenue_rank FROM product_sales"""
    q["customers_ranked_in_state"] = _with(CUSTOMER_VALUE) + """
        SELECT * FROM (SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY state
            ORDER BY lifetime_revenue DESC) AS INTEGER) AS state_rank FROM customer_value)
        WHERE state_rank <= 3"""
    q["running_revenue"] = _with() + """
        SELECT category, order_month, monthly_revenue,
            CAST(SUM(monthly_revenue) OVER (PARTITION BY category ORDER BY order_month
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(34,2))
                 AS running_revenue_total
        FROM (SELECT category, order_month, CAST(SUM(net_sales) AS DECIMAL(24,2)) AS monthly_revenue
              FROM enriched GROUP BY category, order_month)"""
    q["latest_order_per_customer"] = _with() + """
        SELECT customer_id, customer_name, order_id, order_timestamp, product_name, category,
            net_sales, order_status
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY
                order_timestamp DESC NULLS LAST, order_id DESC NULLS LAST,
                net_sales DESC NULLS LAST, product_name DESC NULLS LAST,
                category DESC NULLS LAST, order_status DESC NULLS LAST,
                customer_name DESC NULLS LAST) AS rn
              FROM enriched) WHERE rn = 1"""
    q["latest_profile"] = _with() + f"""
        SELECT * EXCLUDE (rn, ts), 'customers.csv' AS source_file FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ts DESC NULLS LAST,
                {RAW_CUSTOMER_ORDER}) AS rn
            FROM (SELECT *, {_ts('updated_at')} AS ts FROM raw_customers))
        WHERE rn = 1"""
    q["sql_completed_orders"] = _with(COMPLETED) + " SELECT * FROM completed_orders_joined"
    q["sql_monthly_summary"] = _with(COMPLETED, SQL_MONTHLY) + " SELECT * FROM sql_monthly"
    q["sql_product_rank"] = _with(COMPLETED) + """
        SELECT * FROM (SELECT *, CAST(RANK() OVER (PARTITION BY category
            ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank
            FROM (SELECT category, product_id, product_name,
                    CAST(SUM(quantity) AS BIGINT) AS total_quantity,
                    CAST(SUM(net_amount) AS DECIMAL(24,2)) AS total_revenue
                  FROM completed_orders_joined GROUP BY category, product_id, product_name))
        WHERE revenue_rank <= 5"""
    q["sql_top_customers"] = _with(CUSTOMER_VALUE) + """
        SELECT * FROM (SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY state
            ORDER BY lifetime_revenue DESC) AS INTEGER) AS customer_rank FROM customer_value)
        WHERE customer_rank <= 3"""
    # the SQL side from its own statement: sums in cents, averages from sums and counts
    q["sql_vs_api_diff"] = _with(MONTHLY) + """
        , cents AS (
            SELECT order_month, category, order_id, quantity,
                CAST(net_sales * 100 AS BIGINT) AS c FROM enriched),
        stated AS (
            SELECT order_month, category, COUNT(order_id) AS order_count,
                CAST(SUM(quantity) AS BIGINT) AS total_quantity,
                CAST(SUM(c) AS HUGEINT) AS revenue, MIN(c) AS low, MAX(c) AS high
            FROM cents GROUP BY order_month, category),
        agreed AS (
            SELECT COUNT(*) AS n FROM monthly m JOIN stated s
                ON m.order_month IS NOT DISTINCT FROM s.order_month
                AND m.category IS NOT DISTINCT FROM s.category
            WHERE m.order_count = s.order_count
                AND m.total_quantity IS NOT DISTINCT FROM s.total_quantity
                AND CAST(m.total_revenue * 100 AS HUGEINT) IS NOT DISTINCT FROM s.revenue
                AND CAST(m.min_order_value * 100 AS BIGINT) IS NOT DISTINCT FROM s.low
                AND CAST(m.max_order_value * 100 AS BIGINT) IS NOT DISTINCT FROM s.high)
        SELECT (SELECT COUNT(*) FROM monthly) AS api_rows, (SELECT COUNT(*) FROM stated) AS sql_rows,
            n AS matching_rows, (SELECT COUNT(*) FROM monthly) - n AS only_in_api,
            (SELECT COUNT(*) FROM stated) - n AS only_in_sql
        FROM agreed"""
    q["definition_gap"] = _with(MONTHLY, COMPLETED, SQL_MONTHLY) + """
        SELECT COALESCE(a.order_month, s.order_month) AS order_month,
            COALESCE(a.category, s.category) AS category,
            CAST(COALESCE(a.order_count, 0) AS BIGINT) AS api_order_count,
            CAST(COALESCE(s.order_count, 0) AS BIGINT) AS sql_order_count,
            CAST(COALESCE(a.order_count, 0) - COALESCE(s.order_count, 0) AS BIGINT) AS order_count_gap,
            CAST(COALESCE(a.total_revenue, 0) AS DECIMAL(24,2)) AS api_revenue,
            CAST(COALESCE(s.total_revenue, 0) AS DECIMAL(24,2)) AS sql_revenue,
            CAST(COALESCE(a.total_revenue, 0) - COALESCE(s.total_revenue, 0) AS DECIMAL(25,2))
                AS revenue_gap
        FROM monthly a FULL OUTER JOIN sql_monthly s
            ON a.order_month = s.order_month AND a.category = s.category"""
    q["stage_counts"] = _with() + """
        SELECT 'customers' AS dataset,
            (SELECT COUNT(*) FROM raw_customers) AS bronze_rows,
            (SELECT COUNT(*) FROM dedup_customers) AS after_dedup_or_validity_filter,
            (SELECT COUNT(*) FROM silver_customers) AS silver_rows
        UNION ALL
        SELECT 'products', (SELECT COUNT(*) FROM raw_products),
            (SELECT COUNT(*) FROM valid_products), (SELECT COUNT(*) FROM silver_products)
        UNION ALL
        SELECT 'orders', (SELECT COUNT(*) FROM raw_orders),
            (SELECT COUNT(*) FROM silver_orders), (SELECT COUNT(*) FROM financial_orders)"""
    q["duplicate_keys"] = _with() + """
        SELECT dataset, CAST(SUM(n) AS BIGINT) AS rows, CAST(COUNT(*) AS BIGINT) AS distinct_keys,
            CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys,
            CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicated_keys
        FROM (
            SELECT 'customers' AS dataset, customer_id AS k, COUNT(*) AS n
                FROM typed_customers GROUP BY customer_id
            UNION ALL
            SELECT 'products', product_id, COUNT(*) FROM typed_products GROUP BY product_id
            UNION ALL
            SELECT 'orders', order_id, COUNT(*) FROM typed_orders GROUP BY order_id)
        GROUP BY dataset"""
    rejects = []
    parsed = {
        "customers": ("raw_customers", {"signup_date": "date", "date_of_birth": "date",
                                        "updated_at": "timestamp", "loyalty_points": "INTEGER"}),
        "products": ("raw_products", {"unit_price": "DECIMAL(12,2)", "cost_price": "DECIMAL(12,2)",
                                      "stock_quantity": "INTEGER", "launch_date": "date",
                                      "product_rating": "DOUBLE"}),
        "sales_orders": ("raw_orders", {"order_timestamp": "timestamp",
                                        "promised_delivery_date": "date",
                                        "actual_delivery_date": "date", "quantity": "INTEGER",
                                        "discount_pct": "DECIMAL(5,2)"}),
    }
    for dataset, (table, cols) in parsed.items():
        for c, kind in cols.items():
            rejects.append(
                f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, CAST(COUNT(*) FILTER "
                f"(WHERE {c} IS NOT NULL AND {_parsed(c, kind)} IS NULL) AS BIGINT) AS rejected_rows "
                f"FROM {table}")
    q["parse_rejects"] = _with() + " " + " UNION ALL ".join(rejects)
    q["quarantine_rejects"] = _damaged() + " " + " UNION ALL ".join(
        f"""SELECT '{d}' AS dataset, trim({key}, ' ') AS row_key, '{c}' AS column_name,
            {c} AS raw_value FROM {table} WHERE {c} IS NOT NULL AND {_parsed(c, kind)} IS NULL"""
        for d, (table, cols) in parsed.items() for c, kind in cols.items()
        for key in [{"customers": "customer_id", "products": "product_id"}.get(d, "order_id")])
    bad_order = " OR ".join(f"({c} IS NOT NULL AND {_parsed(c, kind)} IS NULL)"
                            for c, kind in parsed["sales_orders"][1].items())
    q["quarantine_orders"] = _damaged().replace(
        "FROM raw_orders", f"FROM (SELECT * FROM raw_orders WHERE NOT ({bad_order}))"
    ) + " SELECT * FROM silver_orders"
    q["landing_documents"] = """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents"""
    line = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in CUSTOMER_FIELDS) + ")"
    q["landing_broken_lines"] = _with() + f"""
        SELECT 'customers' AS dataset, 'customers.csv' AS source_file,
            CASE WHEN email LIKE '%3@%' THEN array_to_string(string_split({line}, ',')[1:5], ',')
                 ELSE {line} || ',extra,values' END AS raw_line
        FROM raw_customers WHERE email LIKE '%3@%' OR email LIKE '%8@%'"""
    q["incremental_landing"] = _with() + """
        SELECT is_active, COUNT(*) AS rows FROM raw_customers GROUP BY is_active"""
    q["sql_vs_api_cells"] = _with(MONTHLY, COMPLETED, SQL_MONTHLY) + """
        , both_sides AS (
            SELECT COALESCE(m.order_month, s.order_month) AS order_month,
                COALESCE(m.category, s.category) AS category, m.order_count IS NOT NULL AS in_api,
                s.order_count IS NOT NULL AS in_sql, m.order_count AS a1, s.order_count AS b1,
                m.total_quantity AS a2, s.total_units AS b2, m.total_revenue AS a3,
                s.total_revenue AS b3, m.avg_order_value AS a4, s.avg_order_value AS b4,
                m.min_order_value AS a5, s.min_order_value AS b5, m.max_order_value AS a6,
                s.max_order_value AS b6
            FROM monthly m FULL OUTER JOIN sql_monthly s
                ON m.order_month = s.order_month AND m.category = s.category)
        """ + " UNION ALL ".join(
        f"""SELECT order_month, category, '{c}' AS column_name, CAST(a{i} AS VARCHAR) AS left_value,
            CAST(b{i} AS VARCHAR) AS right_value
        FROM both_sides WHERE in_api AND in_sql AND a{i} IS DISTINCT FROM b{i}"""
        for i, c in enumerate(["order_count", "total_quantity", "total_revenue", "avg_order_value",
                               "min_order_value", "max_order_value"], 1)) + """
        UNION ALL SELECT order_month, category, '(rows)', CASE WHEN in_api THEN '1' ELSE '0' END,
            CASE WHEN in_sql THEN '1' ELSE '0' END
        FROM both_sides WHERE NOT (in_api AND in_sql)"""
    q["status_distribution"] = _with() + """
        SELECT order_status, COUNT(*) AS count FROM typed_orders GROUP BY order_status"""
    for name, order in {
        "status_distribution": "order_status NULLS FIRST, count",
        "monthly_category_sales": "order_month NULLS FIRST, category NULLS FIRST",
        "city_sales": "total_revenue DESC NULLS LAST, city NULLS FIRST, state NULLS FIRST, "
                      "region NULLS FIRST",
        "customer_value": "lifetime_revenue DESC NULLS LAST, customer_id, customer_name, "
                          "customer_segment, state",
    }.items():
        q[f"{name}_in_order"] = (f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS position "
                                 f"FROM ({q[name]})")
    q["bronze_customers"] = _with() + """
        SELECT *, 'customers.csv' AS source_file FROM raw_customers"""
    q["bronze_products"] = _with() + """
        SELECT *, 'products.csv' AS source_file FROM raw_products"""
    q["bronze_roundtrip"] = _with() + """
        SELECT *, 'sales_orders.csv' AS source_file FROM raw_orders"""
    q["landed_rows"] = _with() + """
        SELECT 'customers' AS dataset, COUNT(*) AS landed_rows FROM raw_customers
        UNION ALL SELECT 'products', COUNT(*) FROM raw_products
        UNION ALL SELECT 'sales_orders', COUNT(*) FROM raw_orders"""
    q["sales_events"] = _with(MONTHLY, EVENTS) + " SELECT * FROM sales_events"
    # JSON writes a double as Java does: from 10^7 on with an exponent
    cents = "CAST(round(total_revenue * 100) AS HUGEINT)"
    digits = f"rtrim(CAST({cents} AS VARCHAR), '0')"
    plain = f"CAST({cents} // 100 AS VARCHAR) || '.' || " \
            f"CASE WHEN {cents} % 100 = 0 THEN '0' ELSE rtrim(lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'), '0') END"
    power = f"{digits}[1] || '.' || CASE WHEN length({digits}) > 1 THEN {digits}[2:] ELSE '0' END || 'E' " \
            f"|| CAST(length(CAST({cents} AS VARCHAR)) - 3 AS VARCHAR)"
    q["sales_events_json"] = _with(MONTHLY, EVENTS) + f"""
        SELECT '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","sales_month":"'
            || sales_month || '","category":"' || category || '","order_count":' || order_count
            || ',"total_quantity":' || total_quantity || ',"total_revenue":'
            || CASE WHEN total_revenue < 10000000 THEN {plain} ELSE {power} END || '}}' AS value
        FROM sales_events"""
    q["sales_events_stream"] = q["sales_events"]
    q["consumed_latest_events"] = q["sales_events"]
    return q


RAW_EXTRACT_SQL = {
    "customers": _with() + " SELECT * FROM raw_customers",
    "products": _with() + " SELECT * FROM raw_products",
    "sales_orders": _with() + " SELECT * FROM raw_orders",
}
