"""Group measures over a sales table (A1-A9), stated once as SQL expressions.

Every gold mart is ``groupBy(keys).agg(<named measures>)`` and every SQL form
is the ``grouped_select`` of the same names, so the DataFrame and the SQL side
share one definition; only the amount column differs (``net_sales`` of the
enriched fact, ``net_amount`` of the completed orders). All measures are
algebraic, so Spark runs them as a partial (map-side) + final hash
aggregation and a hot key never reaches a reducer as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES: dict[str, str] = {
    "order_count": "count(order_id)",
    "total_quantity": "sum(quantity)",
    "total_revenue": "sum({amount})",
    "avg_order_value": "round(avg({amount}), 2)",
    "min_order_value": "min({amount})",
    "max_order_value": "max({amount})",
    "lifetime_revenue": "sum({amount})",
    "monthly_revenue": "sum({amount})",
    "last_order_at": "max(order_timestamp)",
    # A10: rows that carry a quantity, and the units under their own name
    "quantity_rows": "count(quantity)",
    "total_units": "sum(quantity)",
}


def measure_sql(measure: str, amount: str = "net_sales") -> str:
    if measure not in MEASURES:
        raise KeyError(f"unknown measure {measure}; known: {sorted(MEASURES)}")
    return MEASURES[measure].format(amount=amount)


def group_measures(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(measure_sql(m)).alias(m) for m in measures])


def grouped_select(keys: Sequence[str], measures: dict[str, str], amount: str) -> str:
    """The statement of ``measures`` (output name -> measure) per ``keys`` over
    the table bound as ``:source``."""
    columns = [*keys, *[f"{measure_sql(m, amount)} AS {name}" for name, m in measures.items()]]
    return (f"SELECT {', '.join(columns)} FROM IDENTIFIER(:source) "
            f"GROUP BY {', '.join(keys)}")
