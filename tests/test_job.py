"""The weekly job end to end on the smallest tables."""

import json
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from ledgerlake import registry as R
from ledgerlake.job import run_weekly
from ledgerlake.operators import diff_counts, in_stored_order
from ledgerlake.plans.gold import preview
from ledgerlake.plans.quarantine import ParseFailure
from ledgerlake.session import scratch_dir
from ledgerlake.sources.extracts import damaged_extracts, raw_extracts
from ledgerlake.sources.landing import write_csv


@pytest.fixture
def namespace(spark):
    name = f"weekly_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_weekly_job(spark, namespace):
    out = run_weekly(spark, sf_dir=SF_SMALL, namespace=namespace)
    c = out["counts"]
    assert c["bronze_sales_orders"] == R.orders_extract(spark, SF_SMALL).count()
    assert c["published_events"] == c["consumed_events"] == c["gold_monthly_category_sales"]
    # catalog scan (S2) of a published table equals the independently built mart
    stored = spark.table(f"{namespace}.gold_monthly_category_sales")
    expected = R.q_monthly_category_sales(spark, SF_SMALL)
    assert diff_counts(expected, stored.select(*expected.columns)).first() == (0, 0)
    summary = {r.dataset: r for r in spark.table(f"{namespace}.validation_summary").collect()}
    assert summary["orders"].bronze_rows == c["bronze_sales_orders"]
    assert summary["customers"].silver_rows == c["silver_customers"]
    assert c["duplicate_keys"] == 3 and c["parse_rejects"] == 14
    rejects = spark.table(f"{namespace}.parse_rejects").filter("rejected_rows > 0")
    assert [r.column_name for r in rejects.collect()] == ["unit_price"]
    # the SQL stage: both forms agree, and each result is a table
    diff = spark.table(f"{namespace}.sql_vs_api_diff").first().asDict()
    assert diff == R.q_sql_vs_api_diff(spark, SF_SMALL).first().asDict()
    for name in ("sql_completed_orders", "sql_monthly_summary", "sql_product_rank", "sql_top_customers",
                 "sql_vs_api_cells", "definition_gap", "status_distribution", "stage_counts", "parse_rejects"):
        want = R.QUERIES[name](spark, SF_SMALL)
        table = {"stage_counts": "validation_summary"}.get(name, name)
        assert diff_counts(want, spark.table(f"{namespace}.{table}").select(*want.columns)).first() == (0, 0)
    # silver kept the bronze lineage columns (withColumn-style cleaning)
    assert "source_file" in spark.table(f"{namespace}.silver_orders").columns
    shown = preview(spark.table(f"{namespace}.bronze_customers"), 3)
    assert len(shown) == 3 and json.loads(shown[0])["source_file"] == "customers.csv"

    # a strict rerun over malformed extracts: the rejects are there, the rest as before
    landing = scratch_dir(spark, "landing-damaged")
    for name, df in damaged_extracts(spark, SF_SMALL).items():
        write_csv(df, f"{landing}/{name}.csv")
    before = spark.table(f"{namespace}.silver_orders").count()
    with pytest.raises(ParseFailure):
        run_weekly(spark, landing=landing, namespace=namespace)
    want = R.q_quarantine_rejects(spark, SF_SMALL)
    got = spark.table(f"{namespace}.rejected_rows")
    assert diff_counts(want, got.select(*want.columns)).first() == (0, 0)
    assert spark.table(f"{namespace}.silver_orders").count() == before
    # lenient: it runs, with the same reject rows, and replaces the tables
    run_weekly(spark, landing=landing, namespace=namespace, on_bad="quarantine", buckets=4)
    got = spark.table(f"{namespace}.rejected_rows")
    assert diff_counts(want, got.select(*want.columns)).first() == (0, 0)
    want = R.q_quarantine_orders(spark, SF_SMALL)
    assert diff_counts(want, spark.table(f"{namespace}.silver_orders").select(*want.columns)).first() == (0, 0)


def test_weekly_job_from_landing_folder_with_custom_names(spark):
    landing = scratch_dir(spark, "landing-custom")
    names = {"customers": "customers_500.csv", "products": "products_500.csv",
             "sales_orders": "sales_orders_500.csv"}
    for name, df in raw_extracts(spark, SF_SMALL).items():
        write_csv(df, f"{landing}/{names[name]}")
    out = run_weekly(spark, landing=landing, files=names)
    c = out["counts"]
    assert c["bronze_sales_orders"] == R.orders_extract(spark, SF_SMALL).count()
    assert c["silver_sales_enriched"] == R.q_sales_enriched(spark, SF_SMALL).count()
    assert c["published_events"] == c["consumed_events"] == c["gold_monthly_category_sales"]
    # shown sorted, stored sorted
    cities = in_stored_order(spark.read.parquet(f"{out['root']}/gold_city_sales"))
    totals = [r["total_revenue"] for r in cities.orderBy("position").collect()]
    assert totals == sorted(totals, reverse=True) and len(totals) > 5


def test_weekly_job_loads_each_file_once(spark, namespace):
    """Three runs over one landing folder and ledger: all, nothing, one new file."""
    root = scratch_dir(spark, "weekly-ledger")
    extracts = raw_extracts(spark, SF_SMALL)
    orders = extracts["sales_orders"]
    late = F.crc32("order_id") % 4 == 0
    extracts["sales_orders"] = orders.filter(~late)
    for name, df in extracts.items():
        write_csv(df.coalesce(1), f"{root}/in/{name}.csv")
    run = lambda: run_weekly(spark, landing=f"{root}/in", namespace=namespace,
                             ledger=f"{root}/ledger")["counts"]
    first = run()
    assert first["new_rows_sales_orders"] == extracts["sales_orders"].count()
    second = run()
    assert {k: v for k, v in second.items() if k.startswith("new_")} == {
        f"new_{what}_{name}": 0 for what in ("files", "rows") for name in extracts}
    assert second["silver_orders"] == first["silver_orders"]
    write_csv(orders.filter(late).coalesce(1), f"{root}/in/sales_orders.csv", mode="append")
    third = run()
    assert third["new_files_sales_orders"] == 1 and third["new_files_customers"] == 0
    assert third["new_rows_sales_orders"] == orders.filter(late).count()
    want = R.q_clean_orders(spark, SF_SMALL)
    assert diff_counts(want, spark.table(f"{namespace}.silver_orders").select(*want.columns)).first() == (0, 0)
    # the table of latest events follows the runs: the last publish of every id
    events = R.q_sales_events(spark, SF_SMALL)
    latest = spark.table(f"{namespace}.latest_events")
    assert third["latest_events"] == latest.count() >= events.count()
    assert diff_counts(events, latest.join(events.select("event_id"), "event_id", "left_semi")
                       .select(*events.columns)).first() == (0, 0)


JOB = """
import sys
from ledgerlake.session import get_session
spark = get_session("local[2]", shuffle_partitions=2, **{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[1],
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.checkpoint.dir": sys.argv[2]})
from ledgerlake.job import run_weekly
run_weekly(spark, sf_dir=sys.argv[3], root=sys.argv[2] + "/run")
spark.stop()
"""


def test_each_bronze_table_is_read_once(tmp_path):
    """From the event log of a whole job: one scan a bronze table."""
    for folder in ("log", "work"):
        (tmp_path / folder).mkdir()
    subprocess.run([sys.executable, "-c", JOB, str(tmp_path / "log"), str(tmp_path / "work"), SF_SMALL],
                   check=True, timeout=600, cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT})
    log, = (tmp_path / "log").iterdir()
    scans = {"customers": 0, "products": 0, "sales_orders": 0}

    def walk(node, seen):
        location = node.get("metadata", {}).get("Location", "")
        for name in scans:
            # a scan of whole lines, not of the broken ones
            if f"landed_{name}]" in location and "whole" in node["metadata"].get("PartitionFilters", ""):
                seen.append(name)
        for child in node["children"]:
            walk(child, seen)

    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"].endswith("SparkListenerSQLExecutionStart"):
            seen = []
            walk(event["sparkPlanInfo"], seen)
            for name in seen:
                scans[name] += 1
    assert scans == {"customers": 1, "products": 1, "sales_orders": 1}
