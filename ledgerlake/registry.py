"""Every result the pipeline produces, as ``(spark, sf_dir) -> DataFrame``.

Each callable reads the provided tables under ``sf_dir`` and builds its
result over the whole tables; the checker compares each against the DuckDB
SQL in ``ledgerlake.oracle`` (same key).

The extracts are landed as CSV, read back as bronze, and silver is built from
that and stored under the shared checkpoint folder (``plans.medallion``), once
per session and state of the input folder's files; results downstream of silver
read the stored tables, as the layered job does.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans import gold, quality, sqlforms
from ledgerlake.operators.ordered import in_stored_order, sorted_rows
from ledgerlake.plans.bronze import (EXTRACT_FILES, broken_lines, land, land_extracts, read_bronze,
                                     scan_bronze, store_bronze)
from ledgerlake.plans.medallion import StoredSilver, build_silver
from ledgerlake.schemas import CUSTOMER_COLUMNS, EXTRACT_COLUMNS
from ledgerlake.session import app_id, input_state, run_dir, scratch_dir
from ledgerlake.sources.extracts import (broken_lines_extract, customers_extract, damaged_extracts,
                                        orders_extract, products_extract, raw_extracts, read_table)
from ledgerlake.sources.landing import scan_csv, source_manifest, whole_lines, write_csv
from ledgerlake.sources.ledger import Landing
from ledgerlake.sources.store import CatalogStore, PathStore
from ledgerlake.streaming import events as ev

Query = Callable[[SparkSession, str], DataFrame]

_STORED: dict[tuple[str, str], tuple[int, StoredSilver]] = {}
_LOCK = threading.Lock()


def landed_bronze(spark: SparkSession, sf_dir: str, landing: str,
                  extracts: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The three extracts landed as CSV under ``landing`` and read back."""
    _, breaks = land(spark, extracts or raw_extracts(spark, sf_dir), landing)
    return {name: read_bronze(spark, landing, name, multi_line=breaks[name]).select(*EXTRACT_COLUMNS[name])
            for name in EXTRACT_FILES}


def silver(spark: SparkSession, sf_dir: str, refresh: bool = False) -> StoredSilver:
    """The stored silver layer for ``sf_dir``: built on first use, and again in
    a new folder once the input's files changed or with ``refresh``. Frames
    over an earlier build keep their files."""
    key = (app_id(spark), os.path.abspath(sf_dir))
    state = input_state(spark, sf_dir)
    with _LOCK:
        if refresh or key not in _STORED or _STORED[key][0] != state:
            root = scratch_dir(spark, "silver")
            bronze = landed_bronze(spark, sf_dir, f"{root}/landing")
            _STORED[key] = (state, build_silver(spark, bronze, root))
        return _STORED[key][1]


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).enriched


def _views(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Temp-view names for this input folder (distinct per folder, so checks
    over several folders in one session never read each other's views)."""
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    names = ("silver_orders", "silver_customers", "silver_products",
             "silver_sales_enriched", "gold_customer_value", "completed_orders_joined")
    return {n: f"{n}_{tag}" for n in names}


def _register_silver(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    s, v = silver(spark, sf_dir), _views(spark, sf_dir)
    sqlforms.register({
        v["silver_orders"]: s.orders,
        v["silver_customers"]: s.customers,
        v["silver_products"]: s.products,
    })
    return v


def _completed_view(spark: SparkSession, sf_dir: str) -> str:
    v = _register_silver(spark, sf_dir)
    sqlforms.completed_orders_joined(
        spark, v["silver_orders"], v["silver_customers"], v["silver_products"]
    ).createOrReplaceTempView(v["completed_orders_joined"])
    return v["completed_orders_joined"]


def q_clean_customers(spark, sf_dir):
    return silver(spark, sf_dir).customers


def q_clean_products(spark, sf_dir):
    return silver(spark, sf_dir).products


def q_clean_orders(spark, sf_dir):
    return silver(spark, sf_dir).orders


def q_financial_orders(spark, sf_dir):
    return silver(spark, sf_dir).financial_orders


def q_sales_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_monthly_category_sales(spark, sf_dir):
    return gold.monthly_category_sales(enriched(spark, sf_dir))


def q_category_month_stats(spark, sf_dir):
    return gold.category_month_stats(enriched(spark, sf_dir))


def q_city_sales(spark, sf_dir):
    return gold.city_sales(enriched(spark, sf_dir))


def q_customer_value(spark, sf_dir):
    return gold.customer_value(enriched(spark, sf_dir))


def q_top_products_by_category(spark, sf_dir):
    return gold.top_products_by_category(enriched(spark, sf_dir))


def q_product_rank_all(spark, sf_dir):
    return gold.product_rank_all(enriched(spark, sf_dir))


def q_customers_ranked_in_state(spark, sf_dir):
    return gold.customers_ranked_in_state(gold.customer_value(enriched(spark, sf_dir)))


def q_running_revenue(spark, sf_dir):
    return gold.running_revenue(enriched(spark, sf_dir))


def q_latest_order_per_customer(spark, sf_dir):
    return gold.latest_order_per_customer(enriched(spark, sf_dir))


def q_latest_profile(spark, sf_dir):
    """D14 from the stored bronze table, with its lineage (without the load
    time, which differs per run)."""
    return gold.latest_customer_profile(_bronze(spark, sf_dir, "customers"))


def q_sql_completed_orders(spark, sf_dir):
    v = _register_silver(spark, sf_dir)
    return sqlforms.completed_orders_joined(spark, v["silver_orders"], v["silver_customers"],
                                            v["silver_products"])


def q_sql_monthly_summary(spark, sf_dir):
    return sqlforms.monthly_summary(spark, _completed_view(spark, sf_dir))


def q_sql_product_rank(spark, sf_dir):
    return sqlforms.product_rank(spark, _completed_view(spark, sf_dir))


def q_sql_top_customers(spark, sf_dir):
    view = _views(spark, sf_dir)["gold_customer_value"]
    gold.customer_value(enriched(spark, sf_dir)).createOrReplaceTempView(view)
    return sqlforms.top_customers(spark, view)


def q_sql_vs_api_diff(spark, sf_dir):
    e = enriched(spark, sf_dir)
    view = _views(spark, sf_dir)["silver_sales_enriched"]
    e.createOrReplaceTempView(view)
    return sqlforms.sql_vs_api_diff(gold.category_month_stats(e),
                                    sqlforms.category_month_stats_sql(spark, view))


def q_definition_gap(spark, sf_dir):
    completed = _completed_view(spark, sf_dir)
    return sqlforms.definition_gap(gold.category_month_stats(enriched(spark, sf_dir)),
                                   sqlforms.monthly_summary(spark, completed))


def q_stage_counts(spark, sf_dir):
    """What the silver writes counted on the way."""
    return quality.stage_counts(silver(spark, sf_dir).metrics, spark)


def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(*silver(spark, sf_dir).typed)


def q_parse_rejects(spark, sf_dir):
    """What the silver writes counted on the way."""
    return quality.parse_rejects(silver(spark, sf_dir).metrics, spark)


def q_status_distribution(spark, sf_dir):
    return quality.status_distribution(silver(spark, sf_dir).typed[2])


def _quarantined(spark, sf_dir) -> StoredSilver:
    """Silver in quarantine mode from extracts that hold malformed values."""
    root = scratch_dir(spark, "quarantine")
    bronze = landed_bronze(spark, sf_dir, f"{root}/landing", damaged_extracts(spark, sf_dir))
    return build_silver(spark, bronze, root, on_bad="quarantine")


def q_quarantine_rejects(spark, sf_dir):
    """One row per value that can't be parsed, with its column and text."""
    return _quarantined(spark, sf_dir).rejected.drop("source_file")


def q_quarantine_orders(spark, sf_dir):
    """The silver orders that are left once bad rows are set aside."""
    return _quarantined(spark, sf_dir).orders


def q_landing_documents(spark, sf_dir):
    """Texts with line breaks, quotes, separators and empty values landed
    as CSV and read back as text."""
    path = f"{scratch_dir(spark, 'landing-documents')}/documents.csv"
    docs = read_table(spark, sf_dir, "documents")
    write_csv(docs.select(*[F.col(c).cast("string") for c in ("doc_id", "text", "lang", "source")]), path)
    return whole_lines(scan_csv(spark, path, ["doc_id", "text"]))


def q_landing_broken_lines(spark, sf_dir):
    """Lines with too few or too many values, stored apart from bronze
    with their raw text."""
    root = scratch_dir(spark, "landing-broken")
    broken_lines_extract(spark, sf_dir, f"{root}/customers.csv")
    store = PathStore(spark, root)
    store_bronze(store, scan_bronze(spark, root, "customers"), "customers")
    return broken_lines(store, ["customers"])


def q_incremental_landing(spark, sf_dir):
    """S8 + D1: two drops of the customers extract into one folder, the ledger
    loading each file once; the rows per active flag of all loads."""
    root = scratch_dir(spark, "incremental")
    landing, folder = Landing(spark, root), f"{root}/in"
    rows = customers_extract(spark, sf_dir)
    late = F.crc32(F.col("customer_id")) % 2 == 1
    for drop in (rows.filter(~late), rows.filter(late)):
        write_csv(drop, folder, mode="append")
        landing.load("customers", folder, CUSTOMER_COLUMNS)
    landing.load("customers", folder, CUSTOMER_COLUMNS)  # nothing is new
    return landing.read_loaded("customers", CUSTOMER_COLUMNS).groupBy("is_active").agg(
        F.count(F.lit(1)).alias("rows"))


def _in_order(spark, name: str, df: DataFrame) -> DataFrame:
    """O1-O3: stored in its shown order, read back with each row's place."""
    store = PathStore(spark, scratch_dir(spark, f"ordered-{name}"))
    store.write(name, sorted_rows(df, gold.SHOWN_ORDER[name]))
    return in_stored_order(store.read(name))


def q_status_distribution_in_order(spark, sf_dir):
    return _in_order(spark, "status_distribution", q_status_distribution(spark, sf_dir))


def q_monthly_category_sales_in_order(spark, sf_dir):
    return _in_order(spark, "gold_monthly_category_sales", q_monthly_category_sales(spark, sf_dir))


def q_city_sales_in_order(spark, sf_dir):
    return _in_order(spark, "gold_city_sales", q_city_sales(spark, sf_dir))


def q_customer_value_in_order(spark, sf_dir):
    return _in_order(spark, "gold_customer_value", q_customer_value(spark, sf_dir))


def _landing(spark, sf_dir, name="sales_orders") -> str:
    """An extract landed as CSV in this application's landing folder
    (overwritten on every call)."""
    build = {"customers": customers_extract, "products": products_extract,
             "sales_orders": orders_extract}[name]
    landing = run_dir(spark, f"landing-{name}", os.path.abspath(sf_dir))
    return land_extracts(spark, {name: build(spark, sf_dir)}, landing)


def _bronze(spark, sf_dir, name):
    """An extract landed as CSV, read back all-string and tagged, stored
    as the bronze table and read back (without the load time, which differs
    per run)."""
    store = PathStore(spark, run_dir(spark, "bronze", os.path.abspath(sf_dir)))
    store_bronze(store, scan_bronze(spark, _landing(spark, sf_dir, name), name), name)
    return store.read(f"bronze_{name}").drop("ingestion_timestamp")


def q_bronze_customers(spark, sf_dir):
    return _bronze(spark, sf_dir, "customers")


def q_bronze_products(spark, sf_dir):
    return _bronze(spark, sf_dir, "products")


def q_bronze_roundtrip(spark, sf_dir):
    return _bronze(spark, sf_dir, "sales_orders")


def q_source_manifest(spark, sf_dir):
    """S8 over the three landed extracts, a row per file."""
    parts = [source_manifest(spark, f"{_landing(spark, sf_dir, name)}/{file}")
             .select(F.lit(name).alias("dataset"), "*") for name, file in EXTRACT_FILES.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def q_landed_rows(spark, sf_dir):
    """Rows per dataset according to the manifest."""
    return (q_source_manifest(spark, sf_dir).groupBy("dataset")
            .agg(F.sum("row_count").alias("landed_rows")))


def q_sales_events(spark, sf_dir):
    return ev.build_events(ev.gold_extract(gold.monthly_category_sales(enriched(spark, sf_dir))))


def q_sales_events_json(spark, sf_dir):
    return ev.encode(q_sales_events(spark, sf_dir))


def q_sales_events_stream(spark, sf_dir):
    """The weekly export end to end: gold -> CSV extract (K4) -> CSV re-read
    (S5) -> events published to a topic folder (K5) -> drained by a
    streaming query into a JSON-lines sink (T2-T4) -> read back."""
    root = scratch_dir(spark, "events")
    csv, topic = f"{root}/monthly_category_sales.csv", f"{root}/topic"
    sink, ckpt = f"{root}/consumed", f"{root}/checkpoint"
    ev.export_gold_csv(gold.monthly_category_sales(enriched(spark, sf_dir)), csv)
    ev.publish(ev.build_events(ev.read_gold_csv(spark, csv)), topic)
    q = ev.consume(spark, topic, sink, ckpt)
    q.awaitTermination()
    return ev.read_consumed(spark, sink)


def q_sql_vs_api_cells(spark, sf_dir):
    completed = _completed_view(spark, sf_dir)
    return sqlforms.sql_vs_api_cells(gold.category_month_stats(enriched(spark, sf_dir)),
                                     sqlforms.monthly_summary(spark, completed))


def q_consumed_latest_events(spark, sf_dir):
    """Two weekly runs publish the same event ids, the first with larger
    totals; each drain merges its batch into the keyed table, which keeps the
    second run's row per event id."""
    root = scratch_dir(spark, "events-latest")
    store = CatalogStore(spark, f"events_{uuid.uuid4().hex[:12]}", location=f"{root}/tables")
    topic, ckpt = f"{root}/topic", f"{root}/checkpoint"
    events = q_sales_events(spark, sf_dir)
    earlier = events.withColumns({"order_count": F.col("order_count") + 1,
                                  "total_revenue": F.col("total_revenue") + 100.0})
    for batch in (earlier, events):
        ev.publish(batch, topic)
        ev.maintain_latest(spark, topic, store, ckpt).awaitTermination()
    return ev.read_latest(store)


QUERIES: dict[str, Query] = {
    "clean_customers": q_clean_customers,
    "clean_products": q_clean_products,
    "clean_orders": q_clean_orders,
    "financial_orders": q_financial_orders,
    "sales_enriched": q_sales_enriched,
    "monthly_category_sales": q_monthly_category_sales,
    "city_sales": q_city_sales,
    "customer_value": q_customer_value,
    "top_products_by_category": q_top_products_by_category,
    "category_month_stats": q_category_month_stats,
    "latest_profile": q_latest_profile,
    "product_rank_all": q_product_rank_all,
    "customers_ranked_in_state": q_customers_ranked_in_state,
    "running_revenue": q_running_revenue,
    "latest_order_per_customer": q_latest_order_per_customer,
    "sql_completed_orders": q_sql_completed_orders,
    "sql_monthly_summary": q_sql_monthly_summary,
    "sql_product_rank": q_sql_product_rank,
    "sql_top_customers": q_sql_top_customers,
    "sql_vs_api_diff": q_sql_vs_api_diff,
    "definition_gap": q_definition_gap,
    "stage_counts": q_stage_counts,
    "status_distribution": q_status_distribution,
    "duplicate_keys": q_duplicate_keys,
    "parse_rejects": q_parse_rejects,
    "quarantine_rejects": q_quarantine_rejects,
    "quarantine_orders": q_quarantine_orders,
    "landing_documents": q_landing_documents,
    "landing_broken_lines": q_landing_broken_lines,
    "incremental_landing": q_incremental_landing,
    "status_distribution_in_order": q_status_distribution_in_order,
    "monthly_category_sales_in_order": q_monthly_category_sales_in_order,
    "city_sales_in_order": q_city_sales_in_order,
    "customer_value_in_order": q_customer_value_in_order,
    "sql_vs_api_cells": q_sql_vs_api_cells,
    "bronze_customers": q_bronze_customers,
    "bronze_products": q_bronze_products,
    "bronze_roundtrip": q_bronze_roundtrip,
    "source_manifest": q_source_manifest,
    "landed_rows": q_landed_rows,
    "sales_events": q_sales_events,
    "sales_events_json": q_sales_events_json,
    "sales_events_stream": q_sales_events_stream,
    "consumed_latest_events": q_consumed_latest_events,
}
