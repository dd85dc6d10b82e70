"""Data-quality results.

The reference prints ``count()`` after every step (one job each). Here the
counts ride on the writes: each silver write observes its conditions
(``quarantine.write_metrics``), so the summary and the parse rejects cost no
pass over bronze. Duplicate keys and the status distribution are aggregates
over one column of the stored typed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans.quarantine import PARSED_COLUMNS

STAGE_COLUMNS = ["dataset", "bronze_rows", "after_dedup_or_validity_filter", "silver_rows"]


def stage_counts(metrics: dict[str, dict[str, int]], spark: SparkSession) -> DataFrame:
    """3 rows x 4 columns, from what the silver writes counted.

    ``silver_rows`` of orders counts the financial subset (as the reference's
    summary does), although the stored silver_orders table keeps every status.
    """
    rows = [(label, m["rows"], m["valid_rows"], m["silver_rows"])
            for label, m in (("customers", metrics["customers"]), ("products", metrics["products"]),
                             ("orders", metrics["sales_orders"]))]
    return spark.createDataFrame(rows, ", ".join(
        [f"{STAGE_COLUMNS[0]} string", *[f"{c} bigint" for c in STAGE_COLUMNS[1:]]]))


def duplicate_key_counts(dataset: str, typed: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, keys seen more than once and the rows they hold.

    Products and orders are not deduplicated by the pipeline, so a repeated
    key fans out in the joins and is counted twice by the marts; this makes
    that visible. Two aggregates: per key (combined map-side, so a key held
    by a third of all rows is no hot spot), then one global row.
    """
    per_key = typed.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.lit(dataset).alias("dataset"),
        F.sum("__n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.count_if(F.col("__n") > 1).cast("bigint").alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0))
         .cast("bigint").alias("rows_in_duplicated_keys"),
    )


def duplicate_keys(typed_customers: DataFrame, typed_products: DataFrame,
                   typed_orders: DataFrame) -> DataFrame:
    """Q1 addendum: duplicate keys per dataset (trimmed keys; customers by
    version, which the dedup resolves)."""
    return (duplicate_key_counts("customers", typed_customers, "customer_id")
            .unionByName(duplicate_key_counts("products", typed_products, "product_id"))
            .unionByName(duplicate_key_counts("orders", typed_orders, "order_id")))


def parse_rejects(metrics: dict[str, dict[str, int]], spark: SparkSession) -> DataFrame:
    """Per dataset and column: values present but not parseable, as counted by
    the one write of each dataset (no pass of its own)."""
    rows = [(dataset, c, metrics[dataset][f"bad_{c}"])
            for dataset, columns in PARSED_COLUMNS.items() for c in columns]
    return spark.createDataFrame(rows, "dataset string, column_name string, rejected_rows bigint")


def status_distribution(typed_orders: DataFrame) -> DataFrame:
    """Q3: rows per order_status before the quantity filter."""
    return typed_orders.groupBy("order_status").count()
