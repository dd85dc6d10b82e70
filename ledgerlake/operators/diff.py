"""Multiset difference of two frames (``exceptAll`` both ways in one shuffle).

``a.exceptAll(b)`` and ``b.exceptAll(a)`` each shuffle both inputs. Tagging
rows +1 / -1, unioning and summing the tag per distinct row gives both
directions from one aggregation: a positive net count is a row only in
``a`` (that many copies), a negative one a row only in ``b``. NULLs compare
equal, as in ``exceptAll``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = "__side"


def net_row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row whose copy counts differ, with ``net = #left - #right``."""
    cols = left.columns
    both = (left.select(*cols, F.lit(1).alias(_TAG))
            .unionByName(right.select(*cols, F.lit(-1).alias(_TAG))))
    return (both.groupBy(*cols).agg(F.sum(_TAG).alias("net"))
            .filter(F.col("net") != 0))


def diff_counts(left: DataFrame, right: DataFrame, left_name: str = "left",
                right_name: str = "right") -> DataFrame:
    """One row: rows only in ``left`` and only in ``right`` (with multiplicity)."""
    net = net_row_counts(left, right)
    return net.agg(
        F.coalesce(F.sum(F.when(F.col("net") > 0, F.col("net"))), F.lit(0))
         .cast("bigint").alias(f"only_in_{left_name}"),
        F.coalesce(F.sum(F.when(F.col("net") < 0, -F.col("net"))), F.lit(0))
         .cast("bigint").alias(f"only_in_{right_name}"),
    )


def compare_counts(left: DataFrame, right: DataFrame, left_name: str = "left",
                   right_name: str = "right") -> DataFrame:
    """One row: the rows of each side, those that match, and those on one
    side only, all with multiplicity, from one shuffle."""
    cols = left.columns
    both = (left.select(*cols, F.lit(1).alias(_TAG))
            .unionByName(right.select(*cols, F.lit(-1).alias(_TAG))))
    sides = both.groupBy(*cols).agg(F.count_if(F.col(_TAG) == 1).alias("__l"),
                                    F.count_if(F.col(_TAG) == -1).alias("__r"))
    n, m = F.col("__l"), F.col("__r")
    counts = {f"{left_name}_rows": n, f"{right_name}_rows": m, "matching_rows": F.least(n, m),
              f"only_in_{left_name}": F.greatest(n - m, F.lit(0)),
              f"only_in_{right_name}": F.greatest(m - n, F.lit(0))}
    return sides.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
                       for name, c in counts.items()])


ROWS = "(rows)"


def keyed_diff(left: DataFrame, right: DataFrame, keys: Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """Q4: where two tables differ, cell by cell: keys, column_name, left_value,
    right_value (as text). Equal tables give no rows; the order of rows and
    NULLs on both sides play no part.

    Rows meet by key in one shuffle (a tagged union, combined map-side, so a
    key with many rows is no hot spot). A key with one row on each side gives
    a row per differing column. A key that is missing on a side, or repeated
    on one, has no cells to pair up: if its rows differ (by number, or as a
    multiset by the sum of their hashes) it gives one row for the column
    ``(rows)`` with both numbers of rows.
    """
    keys = list(keys)
    columns = [c for c in left.columns if c not in keys] if columns is None else list(columns)
    both = (left.select(*keys, *columns, F.lit(1).alias(_TAG))
            .unionByName(right.select(*keys, *columns, F.lit(-1).alias(_TAG))))
    row = F.struct(*columns)
    digest = F.xxhash64(*columns).cast("decimal(20,0)")
    sides = both.groupBy(*keys).agg(
        F.count_if(F.col(_TAG) == 1).alias("__ln"), F.count_if(F.col(_TAG) == -1).alias("__rn"),
        F.max(F.when(F.col(_TAG) == 1, row)).alias("__l"),
        F.max(F.when(F.col(_TAG) == -1, row)).alias("__r"),
        F.sum(digest * F.col(_TAG)).alias("__net"))
    paired = (F.col("__ln") == 1) & (F.col("__rn") == 1)

    def entry(name: str, a, b):
        return F.struct(F.lit(name).alias("column_name"), a.cast("string").alias("left_value"),
                        b.cast("string").alias("right_value"))

    cells = [F.when(paired & ~F.col(f"__l.{c}").eqNullSafe(F.col(f"__r.{c}")),
                    entry(c, F.col(f"__l.{c}"), F.col(f"__r.{c}"))) for c in columns]
    uneven = ~paired & ((F.col("__ln") != F.col("__rn")) | (F.col("__net") != 0))
    cells.append(F.when(uneven, entry(ROWS, F.col("__ln"), F.col("__rn"))))
    return sides.select(*keys, F.inline(F.array_compact(F.array(*cells))))
