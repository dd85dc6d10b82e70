"""Every registered query against its DuckDB oracle, plus pipeline invariants."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_compare import compare, duck
from ledgerlake import registry as R
from ledgerlake.operators import diff_counts
from ledgerlake.plans import gold

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_a_reason():
    # the corpus operators' queries are checked in tests/llm
    rows_only = set(R.QUERIES) - set(ORACLE)
    assert rows_only == {"source_manifest"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert res["match"], res


def test_parity_query_sees_a_changed_measure(spark):
    from ledgerlake.plans import sqlforms

    fact = R.enriched(spark, SF_SMALL)
    fact.withColumn("net_sales", F.col("net_sales") + F.lit(1).cast("decimal(14,2)")) \
        .createOrReplaceTempView("changed_fact")
    got = sqlforms.sql_vs_api_diff(gold.category_month_stats(fact),
                                   sqlforms.category_month_stats_sql(spark, "changed_fact")).first()
    assert got["api_rows"] == got["sql_rows"] == got["only_in_api"] == got["only_in_sql"] > 0
    assert got["matching_rows"] == 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["order_month", "category", "order_count", "total_quantity",
                          "total_revenue", "avg_order_value"]
    assert df.count() > 0


def test_rows_only_queries_run(spark):
    manifest = QUERIES["source_manifest"](spark, SF_SMALL)
    total = manifest.filter("dataset = 'sales_orders'").agg(F.sum("row_count")).first()[0]
    assert total == R.orders_extract(spark, SF_SMALL).count()


def test_invariants(spark):
    e = R.enriched(spark, SF_SMALL)
    net_total = e.agg(F.sum("net_sales")).first()[0]
    d9 = gold.monthly_category_sales(e)
    assert d9.agg(F.sum("total_revenue")).first()[0] == net_total
    run = gold.running_revenue(e)
    last = (run.groupBy("category").agg(F.max_by("running_revenue_total", "order_month").alias("x"))
            .join(run.groupBy("category").agg(F.sum("monthly_revenue").alias("y")), "category"))
    assert last.filter("x != y").count() == 0
    s = R.silver(spark, SF_SMALL)
    assert s.customers.count() == s.customers.select("customer_id").distinct().count()
    ranked = gold.product_rank_all(e)
    assert ranked.count() == gold.product_sales(e).count()
    top5 = gold.top_products_by_category(e)
    assert diff_counts(top5, ranked.filter("revenue_rank <= 5").select(*top5.columns)).first() == (0, 0)
    top = gold.top_products_by_category(e)
    assert (top.filter("revenue_rank = 1").select("category").distinct().count()
            == e.select("category").distinct().count())


@pytest.mark.parametrize("name", ["customers", "products", "sales_orders"])
def test_raw_extracts_match_the_oracle_adapter(spark, con, name):
    from ledgerlake.oracle import RAW_EXTRACT_SQL
    res = compare(R.raw_extracts(spark, SF_SMALL)[name], con, RAW_EXTRACT_SQL[name])
    assert res["match"], res


def test_json_oracle_writes_doubles_as_spark_does(spark, con):
    """Plain up to 10^7, with an exponent from there on."""
    from ledgerlake.streaming.events import encode

    values = ["0.00", "0.05", "12.30", "100.00", "9999999.99", "10000000.00", "12345678.90", "120000000.00",
              "1234567890123.45"]
    con.execute("CREATE OR REPLACE TEMP VIEW sales_events AS SELECT 'i' AS event_id, 't' AS event_type, "
                "'m' AS sales_month, 'c' AS category, 1 AS order_count, 2 AS total_quantity, "
                f"CAST(unnest({values}) AS DOUBLE) AS total_revenue")
    sql = ORACLE["sales_events_json"]
    got = {r[0] for r in con.sql(sql[sql.rindex("SELECT '{\"event_id"):]).fetchall()}
    con.execute("DROP VIEW sales_events")
    df = spark.createDataFrame([("i", "t", "m", "c", 1, 2, float(v)) for v in values],
                               "event_id string, event_type string, sales_month string, category string, "
                               "order_count bigint, total_quantity bigint, total_revenue double")
    assert got == {r["value"] for r in encode(df).collect()}
