"""Parsing with a quarantine: good and rejected rows apart, in one pass.

Every dataset is parsed leniently, once. A value whose text is there but can't
be parsed is *bad*; its row leaves a reject row with the column's name and
the text, whatever the mode:

* ``"fail"``: as the reference's strict casts, one bad value fails the job,
  but only after the reject rows are stored (``ParseFailure``);
* ``"null"``: the row stays, the value is NULL;
* ``"quarantine"``: the row is set aside and reaches no silver table.

Prices are lenient in every mode, as in the reference: a bad price is listed
and its product fails the validity rule.

Rows get the kinds ``good`` (they pass the dataset's silver rule), ``dropped``
(they don't) and ``rejected`` (besides, if they hold a bad value); the write
sorts them into tables and counts them on the way (Q1, Q2).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans.silver import (has_quantity, has_valid_price, is_financial, type_customers,
                                     type_orders, type_products)
from ledgerlake.schemas import ACTIVE_FLAG
from ledgerlake.sources.store import KINDS, Part

MODES = ("fail", "null", "quarantine")
_RAW, BAD = "__raw", "bad_values"

# How each typed column is parsed from its raw text (the silver rules).
PARSED_COLUMNS = {
    "customers": {"signup_date": "date", "date_of_birth": "date", "updated_at": "timestamp",
                  "loyalty_points": "int"},
    "products": {"unit_price": "decimal(12,2)", "cost_price": "decimal(12,2)",
                 "stock_quantity": "int", "launch_date": "date", "product_rating": "double"},
    "sales_orders": {"order_timestamp": "timestamp", "promised_delivery_date": "date",
                     "actual_delivery_date": "date", "quantity": "int",
                     "discount_pct": "decimal(5,2)"},
}
LENIENT_COLUMNS = {"unit_price", "cost_price"}
REJECT_COLUMNS = ["dataset", "row_key", "source_file", "column_name", "raw_value"]


class ParseFailure(ValueError):
    """Strict parsing met values it can't parse; their rows are stored."""


@dataclass(frozen=True)
class Dataset:
    """One extract: how it is typed, which rows reach silver, its tables."""
    name: str
    key: str
    type: Callable[[DataFrame, str], DataFrame]
    keep: Callable[[], Column]
    silver: str  # the table of the good rows
    counts: Callable[[], dict[str, Column]]  # conditions counted on the write


def _true() -> Column:
    return F.lit(True)


def _active() -> Column:
    return F.col("active_flag") == ACTIVE_FLAG


DATASETS = {
    # the latest-version rule needs all versions: silver follows from the typed table
    "customers": Dataset("customers", "customer_id", type_customers, _true, "typed_customers", dict),
    "products": Dataset("products", "product_id", type_products,
                        lambda: has_valid_price() & _active(), "silver_products",
                        lambda: {"valid_rows": has_valid_price(), "silver_rows": has_valid_price() & _active()}),
    "sales_orders": Dataset("sales_orders", "order_id", type_orders, has_quantity, "silver_orders",
                            lambda: {"valid_rows": has_quantity(),
                                     "silver_rows": has_quantity() & is_financial()}),
}


def _bad_values(dataset: str) -> Column:
    """Over typed rows that keep their raw text in ``_RAW``: what didn't parse
    (the list is only gone through where there is some)."""
    bad = {c: F.col(f"{_RAW}.{c}").isNotNull() & F.col(c).isNull() for c in PARSED_COLUMNS[dataset]}
    listed = F.array_compact(F.array(*[
        F.when(is_bad, F.struct(F.lit(c).alias("column_name"), F.col(f"{_RAW}.{c}").alias("raw_value")))
        for c, is_bad in bad.items()]))
    none = F.array().cast("array<struct<column_name:string,raw_value:string>>")
    return F.when(reduce(or_, bad.values()), listed).otherwise(none)


def typed_with_kinds(bronze: DataFrame, dataset: str, on_bad: str) -> DataFrame:
    """The typed rows with ``bad_values`` and their kinds (a projection)."""
    if on_bad not in MODES:
        raise ValueError(f"on_bad must be one of {MODES}, got {on_bad!r}")
    d = DATASETS[dataset]
    # what an empty text means: nothing to parse (the cleaning rules see it as NULL too)
    raw = F.struct(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in PARSED_COLUMNS[dataset]])
    typed = d.type(bronze.withColumn(_RAW, raw), "null").withColumn(BAD, _bad_values(dataset)).drop(_RAW)
    good = F.coalesce(d.keep(), F.lit(False))
    if on_bad == "quarantine":
        good = good & ~F.exists(BAD, lambda b: ~b["column_name"].isin(*LENIENT_COLUMNS))
    kind = F.when(good, "good").otherwise("dropped")
    kinds = F.when(F.size(BAD) > 0, F.array(kind, F.lit("rejected"))).otherwise(F.array(kind))
    return typed.withColumn(KINDS, kinds)


def parts(dataset: str, columns: list[str]) -> dict[str, Part]:
    """The tables of a dataset's one write."""
    d = DATASETS[dataset]
    own = [c for c in columns if c not in (BAD, KINDS)]
    source = ["source_file"] if "source_file" in own else []
    everything = f"typed_{dataset}" if d.silver != f"typed_{dataset}" else f"all_{dataset}"
    return {d.silver: (["good"], own), everything: (["good", "dropped"], own),
            f"rejected_{dataset}": (["rejected"], [d.key, *source, BAD])}


def write_metrics(dataset: str) -> dict[str, Column]:
    """Q1 as conditions counted while the rows are written."""
    bad = {f"bad_{c}": F.array_contains(f"{BAD}.column_name", c) for c in PARSED_COLUMNS[dataset]}
    return {name: F.count_if(cond) for name, cond in {**DATASETS[dataset].counts(), **bad}.items()}


def reject_rows(rejected: dict[str, DataFrame]) -> DataFrame:
    """One row per bad value of all datasets (``rejected``: dataset -> its
    rejected table)."""
    out = None
    for name, df in rejected.items():
        origin = F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string")
        rows = df.select(F.lit(name).alias("dataset"), F.col(DATASETS[name].key).alias("row_key"),
                         origin.alias("source_file"), F.inline(BAD))
        out = rows if out is None else out.unionAll(rows)
    return out.select(*REJECT_COLUMNS)


def strict_failures(metrics: dict[str, dict[str, int]]) -> dict[str, int]:
    """``dataset.column`` -> bad values, of the columns a strict parse fails on."""
    return {f"{d}.{c}": metrics[d][f"bad_{c}"] for d, cols in PARSED_COLUMNS.items() for c in cols
            if c not in LENIENT_COLUMNS and metrics[d][f"bad_{c}"]}
