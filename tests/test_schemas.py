"""Result schemas equal the reference's (FIXTURES.md section 2): names, order, types."""

import pytest

from conftest import SF_SMALL
from ledgerlake import registry as R

S, TS, D, I, B = "string", "timestamp", "date", "int", "bigint"
M14, M12, M24, A15 = "decimal(14,2)", "decimal(12,2)", "decimal(24,2)", "decimal(15,2)"

EXPECTED = {
    "sales_enriched": [
        ("order_id", S), ("order_timestamp", TS), ("order_month", S), ("customer_id", S),
        ("customer_name", S), ("city", S), ("state", S), ("region", S),
        ("customer_segment", S), ("product_id", S), ("product_name", S), ("category", S),
        ("subcategory", S), ("quantity", I), ("unit_price", M12), ("cost_price", M12),
        ("discount_pct", "decimal(5,2)"), ("gross_amount", M14), ("discount_amount", M14),
        ("net_amount", M14), ("net_sales", M14), ("profit_per_unit", M12),
        ("promised_delivery_date", D), ("actual_delivery_date", D), ("delivery_days", I),
        ("late_delivery_flag", S), ("order_status", S), ("payment_method", S),
        ("sales_channel", S), ("warehouse_id", S)],
    "monthly_category_sales": [
        ("order_month", S), ("category", S), ("order_count", B), ("total_quantity", B),
        ("total_revenue", M24), ("avg_order_value", A15)],
    "category_month_stats": [
        ("order_month", S), ("category", S), ("order_count", B), ("total_quantity", B),
        ("total_revenue", M24), ("avg_order_value", A15), ("min_order_value", M14),
        ("max_order_value", M14)],
    "city_sales": [
        ("city", S), ("state", S), ("region", S), ("order_count", B), ("total_quantity", B),
        ("total_revenue", M24)],
    "customer_value": [
        ("customer_id", S), ("customer_name", S), ("customer_segment", S), ("state", S),
        ("order_count", B), ("lifetime_revenue", M24), ("avg_order_value", A15),
        ("last_order_at", TS)],
    "top_products_by_category": [
        ("category", S), ("product_id", S), ("product_name", S), ("total_quantity", B),
        ("total_revenue", M24), ("revenue_rank", I)],
    "running_revenue": [
        ("category", S), ("order_month", S), ("monthly_revenue", M24),
        ("running_revenue_total", "decimal(34,2)")],
    "latest_order_per_customer": [
        ("customer_id", S), ("customer_name", S), ("order_id", S), ("order_timestamp", TS),
        ("product_name", S), ("category", S), ("net_sales", M14), ("order_status", S)],
    "stage_counts": [
        ("dataset", S), ("bronze_rows", B), ("after_dedup_or_validity_filter", B),
        ("silver_rows", B)],
    "sales_events": [
        ("event_id", S), ("event_type", S), ("sales_month", S), ("category", S),
        ("order_count", B), ("total_quantity", B), ("total_revenue", "double")],
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_result_schema_matches_reference(spark, name):
    df = R.QUERIES[name](spark, SF_SMALL)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    assert got == EXPECTED[name]
