"""Running total per group (ROWS UNBOUNDED PRECEDING .. CURRENT ROW).

Callers aggregate to the ordering grain first (e.g. category x month), so
the window only sees one row per period: its input is bounded by
groups x periods, not by the fact size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group_cols: Sequence[str], order_col: str, value_col: str,
                  out_col: str) -> DataFrame:
    w = (Window.partitionBy(*group_cols).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out_col, F.sum(value_col).over(w))
