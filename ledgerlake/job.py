"""The weekly job, end to end, as one Spark application.

Stages run in the reference's order -- bronze, silver/gold, windows, SQL, export,
publish, consume -- but every hand-off is a stored table or folder, and no
stage collects data to the driver (only observed row counts come back):

1. landing: the three CSV extracts (given, or derived from ``sf_dir``);
2. bronze: all-string scan + lineage columns, stored; lines that are not whole
   are stored apart (D1-D3);
3. silver: typed in one pass that writes good, dropped and rejected rows apart
   and counts them; latest customers (D4-D6). ``on_bad`` says what a value
   that can't be parsed does (``plans.quarantine``);
4. gold: enriched fact + marts from the stored fact (D8-D13, D17, D18);
5. data quality: validation summary (D23) and parse rejects from the counts of
   the silver writes, duplicate keys and rows per order status (Q3) from the
   stored typed rows; no stage reads bronze a second time;
6. the SQL forms over views of the stored tables (D19-D22), the comparison of
   the two forms (Q4), in total and cell by cell, and the gap between their
   definitions;
7. export: gold extract to CSV (K4), re-read (S5), published (K5);
8. consume: streaming drain of the topic into JSON lines (T2-T4) and, with a
   namespace, into the table of the latest copy of every event (D25).

With a ``ledger`` folder, kept from run to run, landed files are loaded once:
bronze is all loads so far, and a run that finds nothing new loads nothing.
With a catalog ``namespace`` all tables are versions of managed tables, switched
in at the end (``sources.store.CatalogStore``): readers of the namespace see the
last whole run until then. Without one they are folders under the run root.

    python -m ledgerlake.job --sf-dir /root/testdata/sf0.01 [--namespace retail]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.concurrency import run_concurrently
from ledgerlake.plans import sqlforms
from ledgerlake.plans.bronze import (EXTRACT_FILES, broken_lines, land, scan_bronze,
                                     store_bronze)
from ledgerlake.plans.medallion import REJECTED, Store, StoredSilver, build_gold, build_silver
from ledgerlake.plans.quality import (duplicate_keys, parse_rejects, stage_counts,
                                     status_distribution)
from ledgerlake.plans.quarantine import MODES, ParseFailure
from ledgerlake.schemas import EXTRACT_COLUMNS
from ledgerlake.session import cluster_conf, get_session, scratch_dir, stored_bytes
from ledgerlake.sources.extracts import raw_extracts
from ledgerlake.sources.ledger import Landing
from ledgerlake.sources.store import CatalogStore, PathStore
from ledgerlake.streaming import events as ev

BROKEN_LINES = "broken_lines"


def sql_tables(spark: SparkSession, silver: StoredSilver) -> dict[str, DataFrame]:
    """Stage 6: each result of the SQL forms, over temporary views (K3)."""
    stats = silver.table("agg_category_month_stats")
    sqlforms.register({"silver_orders": silver.orders, "silver_customers": silver.customers,
                       "silver_products": silver.products,
                       "gold_customer_value": silver.table("gold_customer_value"),
                       "silver_sales_enriched": silver.enriched})
    completed = sqlforms.completed_orders_joined(spark)
    sqlforms.register({"completed_orders_joined": completed})
    monthly = sqlforms.monthly_summary(spark)
    return {
        "sql_completed_orders": completed,
        "sql_monthly_summary": monthly,
        "sql_product_rank": sqlforms.product_rank(spark),
        "sql_top_customers": sqlforms.top_customers(spark),
        "sql_vs_api_diff": sqlforms.sql_vs_api_diff(stats, sqlforms.category_month_stats_sql(spark)),
        "sql_vs_api_cells": sqlforms.sql_vs_api_cells(stats, monthly),
        "definition_gap": sqlforms.definition_gap(stats, monthly),
    }


def _bronze(spark: SparkSession, store: Store, landing: str, files: dict[str, str],
            multi_line: dict[str, bool], counts: dict[str, int]) -> dict[str, DataFrame]:
    """Stage 2 from the whole landing folder: bronze and broken lines stored."""
    landed = run_concurrently({name: (lambda name=name: store_bronze(
        store, scan_bronze(spark, landing, name, file_name=files.get(name),
                           multi_line=multi_line[name]), name))
        for name in EXTRACT_FILES})
    counts.update({f"bronze_{name}": n["whole_rows"] for name, n in landed.items()})
    counts[BROKEN_LINES] = store.write(BROKEN_LINES, broken_lines(store, list(EXTRACT_FILES)))["rows"]
    return {name: store.read(f"bronze_{name}") for name in EXTRACT_FILES}


def _bronze_of_ledger(spark: SparkSession, store: Store, landing: str, files: dict[str, str],
                      ledger: str, counts: dict[str, int]) -> dict[str, DataFrame]:
    """Stage 2 with a ledger: only new files are loaded."""
    loads = Landing(spark, ledger)
    for name, default in EXTRACT_FILES.items():
        new = loads.load(name, f"{landing}/{files.get(name, default)}", EXTRACT_COLUMNS[name])
        counts[f"new_files_{name}"], counts[f"new_rows_{name}"] = new["files"], new["rows"]
    broken = None
    for name in EXTRACT_FILES:
        rows = loads.read_loaded(name, EXTRACT_COLUMNS[name], broken=True).select(
            F.lit(name).alias("dataset"), "source_file", "raw_line")
        broken = rows if broken is None else broken.unionAll(rows)
    counts[BROKEN_LINES] = store.write(BROKEN_LINES, broken)["rows"]
    return {name: loads.read_loaded(name, EXTRACT_COLUMNS[name]) for name in EXTRACT_FILES}


def _store_all(store: Store, tables: dict[str, DataFrame]) -> dict[str, int]:
    return run_concurrently({name: (lambda df=df, name=name: store.write(name, df)["rows"])
                             for name, df in tables.items()})


def run_weekly(spark: SparkSession, sf_dir: str | None = None, landing: str | None = None,
               root: str | None = None, namespace: str | None = None,
               fmt: str = "parquet", files: dict[str, str] | None = None,
               on_bad: str = "fail", buckets: int | None = None, ledger: str | None = None,
               multi_line: bool = True) -> dict:
    """Run every stage; ``files`` maps customers / products / sales_orders to
    their file names under ``landing`` when they differ from the defaults;
    ``multi_line=False`` says that no landed value holds a line break, so that
    large files are read by many tasks.

    A strict run (``on_bad="fail"``) that meets values it can't parse stores
    (and publishes) the broken lines and the reject rows, then raises
    ``ParseFailure``; every other table keeps its last state.
    """
    if sf_dir is None and landing is None:
        raise ValueError("give the landing folder or the provided-table folder")
    root = root or scratch_dir(spark, "weekly")
    store: Store = (CatalogStore(spark, namespace, fmt, buckets=buckets) if namespace
                    else PathStore(spark, root, fmt))
    breaks = dict.fromkeys(EXTRACT_FILES, multi_line)
    if landing is None:
        landing, breaks = land(spark, raw_extracts(spark, sf_dir), f"{root}/landing")
    counts: dict[str, int] = {}

    files = files or {}
    bronze = (_bronze_of_ledger(spark, store, landing, files, ledger, counts) if ledger
              else _bronze(spark, store, landing, files, breaks, counts))

    try:
        silver = build_silver(spark, bronze, on_bad=on_bad, store=store)
    except ParseFailure:
        store.publish([BROKEN_LINES, REJECTED])
        raise
    counts.update(silver.counts)
    counts.update(build_gold(silver))
    counts.update(_store_all(store, {
        "validation_summary": stage_counts(silver.metrics, spark),
        "parse_rejects": parse_rejects(silver.metrics, spark),
        "duplicate_keys": duplicate_keys(*silver.typed),
        "status_distribution": status_distribution(silver.typed[2]),
        **sql_tables(spark, silver),
    }))

    monthly = silver.table("gold_monthly_category_sales")
    export = f"{root}/export/monthly_category_sales.csv"
    ev.export_gold_csv(monthly, export)
    topic, sink = f"{root}/topic", f"{root}/consumed_events"
    counts["published_events"] = ev.publish(ev.build_events(ev.read_gold_csv(spark, export)),
                                            topic)
    ev.consume(spark, topic, sink, f"{root}/_checkpoints/consumer").awaitTermination()
    counts["consumed_events"] = ev.read_consumed(spark, sink).count()
    store.publish()
    if isinstance(store, CatalogStore):
        ev.maintain_latest(spark, topic, store, f"{root}/_checkpoints/latest").awaitTermination()
        counts[ev.LATEST] = ev.read_latest(store).count()
    return {"root": root, "counts": counts}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--sf-dir", help="folder of the provided tables (extracts are derived)")
    ap.add_argument("--landing", help="folder holding the three CSV extracts")
    ap.add_argument("--root", help="run folder (default: new folder in spark.checkpoint.dir)")
    ap.add_argument("--namespace", help="write versioned managed tables of this schema")
    ap.add_argument("--on-bad", default="fail", choices=MODES,
                    help="what a value that can't be parsed does")
    ap.add_argument("--plain-lines", action="store_true",
                    help="no landed value holds a line break: split large files")
    ap.add_argument("--ledger", help="folder of the loaded files' ledger, kept from run to run")
    ap.add_argument("--buckets", type=int,
                    help="bucket customers and orders by customer (with --namespace)")
    ap.add_argument("--format", default="parquet", help="table format (parquet, delta, ...)")
    ap.add_argument("--files", default="",
                    help="landing file names, e.g. customers=customers_500.csv,products=...")
    ap.add_argument("--master", help="Spark master when no session is active")
    ap.add_argument("--input-bytes", type=int,
                    help="size the settings for this much input (default: the bytes found)")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if not (a.landing or a.sf_dir):
        ap.error("give --landing or --sf-dir")
    input_bytes = a.input_bytes or stored_bytes(spark, a.landing or a.sf_dir)
    for key, value in cluster_conf(input_bytes, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    files = dict(kv.split("=", 1) for kv in a.files.split(",") if kv)
    out = run_weekly(spark, a.sf_dir, a.landing, a.root, a.namespace, a.format, files,
                     a.on_bad, a.buckets, a.ledger, not a.plain_lines)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
