"""The layered job's stored tables equal the independently built results."""

import shutil

import pyarrow.parquet as pq

from conftest import SF_SMALL
from ledgerlake import registry as R
from ledgerlake.operators import diff_counts
from ledgerlake.plans.medallion import build_gold

PAIRS = {
    "silver_sales_enriched": "sales_enriched",
    "gold_monthly_category_sales": "monthly_category_sales",
    "gold_city_sales": "city_sales",
    "gold_customer_value": "customer_value",
    "gold_top_products_by_category": "top_products_by_category",
    "agg_category_month_stats": "category_month_stats",
    "agg_running_revenue_by_category": "running_revenue",
    "agg_latest_order_per_customer": "latest_order_per_customer",
}


def test_stored_layers_match_queries(spark):
    silver = R.silver(spark, SF_SMALL)
    assert silver.counts["silver_orders"] == R.q_clean_orders(spark, SF_SMALL).count()
    counts = dict(silver.counts)
    counts.update(build_gold(silver))
    joined = silver.join_enriched()
    assert diff_counts(joined, silver.enriched.select(*joined.columns)).first() == (0, 0)
    for table, query in PAIRS.items():
        expected = R.QUERIES[query](spark, SF_SMALL)
        stored = spark.read.parquet(f"{silver.root}/{table}").select(*expected.columns)
        assert counts[table] == expected.count(), table
        assert diff_counts(expected, stored).first() == (0, 0), table


def test_silver_follows_its_input(spark, tmp_path):
    folder = tmp_path / "tables"
    shutil.copytree(SF_SMALL, folder)
    first = R.silver(spark, str(folder))
    assert R.silver(spark, str(folder)) is first
    n = first.customers.count()
    table = pq.read_table(folder / "customer.parquet")
    for part in (folder, folder / "customer.parquet"):
        part.chmod(0o755)
    pq.write_table(table.slice(0, table.num_rows // 2), folder / "customer.parquet")
    second = R.silver(spark, str(folder))
    assert second.root != first.root and second.customers.count() < n
    assert first.customers.count() == n  # frames over the earlier build keep their files
