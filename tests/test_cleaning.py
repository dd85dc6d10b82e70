"""Cleaning rules on hand-made edge rows (one case per quirk in SURVEY section 8)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.medallion import build_silver
from ledgerlake.plans.quarantine import ParseFailure
from ledgerlake.plans.silver import (clean_customers, clean_orders, clean_products, enrich,
                                     financial_orders, type_customers, type_products)
from ledgerlake.plans.sqlforms import completed_orders_joined, register
from ledgerlake.schemas import CUSTOMERS_RAW, ORDERS_RAW, PRODUCTS_RAW
from ledgerlake.session import scratch_dir
from ledgerlake.sources.store import PathStore


def cust(spark, rows):
    return spark.createDataFrame(rows, CUSTOMERS_RAW)


def c_row(cid, name="ann lee", city="paris", active="y", updated="2024-01-01 00:00:00",
          points="1", signup="2020-01-01"):
    return (cid, name, "a@x.com ", city, " ile-de-france ", " europe", "home office", active,
            signup, "1990-05-05", updated, points)


def test_customer_trim_case_and_city_default(spark):
    df = cust(spark, [c_row(" 1 ", name=" mARY-ann o'neil ", city="  ", active=" Y "),
                      c_row("2", city=None), c_row("3", city="new-york ST.")])
    got = {r.customer_id: r for r in clean_customers(df).collect()}
    assert got["1"].customer_name == "Mary-ann O'neil"
    assert got["1"].city == "Unknown" and got["2"].city == "Unknown"
    assert got["3"].city == "New-york St."
    assert got["1"].state == "Ile-de-france" and got["1"].region == "EUROPE"
    assert got["1"].customer_segment == "Home Office" and got["1"].email == "a@x.com"


def test_dedup_then_active_filter_drops_inactive_latest(spark):
    df = cust(spark, [
        c_row("7", active="y", updated="2024-01-01 00:00:00"),
        c_row(" 7", active="n", updated="2024-02-01 00:00:00"),   # latest is inactive
        c_row("8", active="n", updated="2024-01-01 00:00:00"),
        c_row("8", active="y", updated=None),                      # NULL time sorts last
        c_row("9", active="y", updated="2024-01-01 00:00:00", points="5"),
        c_row("9", active="y", updated="2024-01-01 00:00:00", points="6"),  # tie
    ])
    got = {r.customer_id: r for r in clean_customers(df).collect()}
    assert "7" not in got and "8" not in got
    assert got["9"].loyalty_points == 6  # tie broken by the remaining columns, descending


def test_strict_and_lenient_parsing(spark):
    df = cust(spark, [c_row("1", signup="2020-13-45", points="7.9")])
    with pytest.raises(Exception):
        type_customers(df, on_bad="fail").collect()
    r = type_customers(df, on_bad="null").first()
    assert r.signup_date is None and r.loyalty_points is None


def p_row(pid, unit="10.00", cost="5.00", active="y", category="home goods"):
    return (pid, "desk lamp", category, "lamps", "acme co", active, unit, cost, "3",
            "2020-01-01", "4.5")


def test_product_price_validity(spark):
    rows = [p_row("ok"), p_row("abc", unit="abc"), p_row("null", unit=None),
            p_row("zero", unit="0"), p_row("neg", unit="-1.00"), p_row("exp", unit="1e3"),
            p_row("big", unit="12345678901234"), p_row("three", unit="12.345"),
            p_row("nocost", cost=None), p_row("inactive", active="n"), p_row("nullflag", active=None)]
    df = spark.createDataFrame(rows, PRODUCTS_RAW)
    typed = {r.product_id: r for r in type_products(df).collect()}
    assert typed["abc"].unit_price is None and typed["big"].unit_price is None
    assert typed["exp"].unit_price == Decimal("1000.00")
    assert typed["three"].unit_price == Decimal("12.35")  # half-up
    kept = sorted(r.product_id for r in clean_products(df).collect())
    assert kept == ["exp", "ok", "three"]
    assert typed["ok"].category == "Home Goods"


def o_row(oid, cid="1", pid="p", status="completed", qty="2", disc="5", actual="2024-01-12",
          promised="2024-01-10"):
    return (oid, cid, pid, "card", status, "web", "w1", "2024-01-05 10:00:00", promised, actual,
            qty, disc)


def test_order_filters(spark):
    rows = [o_row("a"), o_row("b", qty="-1"), o_row("c", qty="0"), o_row("d", qty=None),
            o_row("e", status=" pending"), o_row("f", status="CANCELLED"),
            o_row("g", status=None), o_row("h", status="returned")]
    df = spark.createDataFrame(rows, ORDERS_RAW)
    silver = clean_orders(df)
    assert sorted(r.order_id for r in silver.collect()) == ["a", "e", "f", "g", "h"]
    fin = sorted(r.order_id for r in financial_orders(silver).collect())
    assert fin == ["a", "h"]  # NULL status is dropped too


def test_enriched_money_and_delivery(spark):
    cust_df = cust(spark, [c_row("1")])
    prod = spark.createDataFrame([p_row("p", unit="0.05", cost="0.01")], PRODUCTS_RAW)
    orders = spark.createDataFrame([
        o_row("late"), o_row("early", actual="2024-01-08"), o_row("open", actual=None)],
        ORDERS_RAW)
    e = {r.order_id: r for r in enrich(financial_orders(clean_orders(orders)),
                                       clean_products(prod), clean_customers(cust_df)).collect()}
    r = e["late"]
    # gross 0.10, 5 % discount: discount rounds to 0.01 first, net 0.09
    assert (r.gross_amount, r.discount_amount, r.net_amount) == (
        Decimal("0.10"), Decimal("0.01"), Decimal("0.09"))
    assert r.net_sales == r.net_amount and r.profit_per_unit == Decimal("0.04")
    assert (r.delivery_days, r.late_delivery_flag) == (2, "Y")
    assert (e["early"].delivery_days, e["early"].late_delivery_flag) == (-2, "N")
    assert (e["open"].delivery_days, e["open"].late_delivery_flag) == (None, "N")
    assert r.order_month == "2024-01"
    # the SQL form rounds once: 0.10 * 0.95 = 0.095 -> 0.10
    register({"t_orders": clean_orders(orders), "t_customers": clean_customers(cust_df),
              "t_products": clean_products(prod)})
    sql = completed_orders_joined(spark, "t_orders", "t_customers", "t_products")
    assert sql.filter(F.col("order_id") == "late").first().net_amount == Decimal("0.10")


def damaged(spark):
    return {
        "customers": cust(spark, [c_row("1", signup="2020-13-45", points="7.9"), c_row("2"), c_row("3", points="")]),
        "products": spark.createDataFrame([p_row("a", unit="abc"), p_row("b", cost=None), p_row("p")],
                                          PRODUCTS_RAW),
        "sales_orders": spark.createDataFrame([
            o_row("x", cid="2", qty="two", promised="2024-02-30"), o_row("y", cid="2", actual=None),
            o_row("z", cid="1", qty="0"), o_row("v", cid="1", disc="5%")], ORDERS_RAW),
    }


BAD = {("customers", "1", "signup_date", "2020-13-45"), ("customers", "1", "loyalty_points", "7.9"),
       ("products", "a", "unit_price", "abc"), ("sales_orders", "x", "quantity", "two"),
       ("sales_orders", "x", "promised_delivery_date", "2024-02-30"), ("sales_orders", "v", "discount_pct", "5%")}


def bad_rows(df):
    return {(r.dataset, r.row_key, r.column_name, r.raw_value) for r in df.collect()}


@pytest.mark.parametrize("mode,orders,customers", [("null", {"y", "v"}, {"1", "2", "3"}),
                                                   ("quarantine", {"y"}, {"2", "3"})])
def test_rejected_values_are_stored_apart(spark, mode, orders, customers):
    from ledgerlake.plans.quality import parse_rejects, stage_counts

    silver = build_silver(spark, damaged(spark), on_bad=mode)
    assert bad_rows(silver.rejected) == BAD
    assert {r.order_id for r in silver.orders.collect()} == orders
    assert {r.customer_id for r in silver.customers.collect()} == customers
    assert [r.product_id for r in silver.products.collect()] == ["p"]
    counted = {(r.dataset, r.column_name): r.rejected_rows
               for r in parse_rejects(silver.metrics, spark).collect() if r.rejected_rows}
    assert counted == {(d, c): 1 for d, _, c, _ in BAD}
    summary = {r.dataset: tuple(r)[1:] for r in stage_counts(silver.metrics, spark).collect()}
    assert summary["products"] == (3, 1, 1) and summary["orders"][0] == 4
    assert summary["customers"] == ((3, 3, 3) if mode == "null" else (3, 2, 2))
    # every row is somewhere: good or dropped
    assert [t.count() for t in silver.typed] == [3, 3, 4]


def test_strict_parsing_fails_after_the_rejects_are_stored(spark):
    store = PathStore(spark, scratch_dir(spark, "strict"))
    with pytest.raises(ParseFailure, match="sales_orders.quantity"):
        build_silver(spark, damaged(spark), on_bad="fail", store=store)
    assert bad_rows(store.read("rejected_rows")) == BAD
    # a bad price alone is no failure, as in the reference
    good = damaged(spark)
    good["customers"] = good["customers"].filter("customer_id <> '1'")
    good["sales_orders"] = good["sales_orders"].filter("order_id IN ('y', 'z')")
    assert bad_rows(build_silver(spark, good).rejected) == {("products", "a", "unit_price", "abc")}
