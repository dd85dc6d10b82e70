"""Stored order (O1-O3): a table whose files, read in name order, are sorted.

A global sort before a write costs a range shuffle and pays off only where
readers want the order: the rows are dealt to ranges of the sort columns,
sorted inside each, and written by as many tasks, whose file names carry the
range's number. No task sorts more than its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sorted_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in ``order`` (``"column"`` or ``"column desc"``; NULLs first, last
    when descending), ties by the other columns, so the order is total."""
    named = [c.removesuffix(" desc") for c in order]
    keys = [F.col(c).desc() if c != o else F.col(c) for c, o in zip(named, order)]
    return df.orderBy(*keys, *[c for c in df.columns if c not in named])


def in_stored_order(stored: DataFrame, position: str = "position") -> DataFrame:
    """A scan of files with every row's place in them (from 1), files taken in
    name order.

    The rows before a file come from one running sum over the files' row
    counts (a row a file, so the broadcast is bounded by their number); the
    place inside the file is the scan's own row index.
    """
    rows = stored.select("*", F.col("_metadata.file_name").alias("__file"),
                         F.col("_metadata.row_index").alias("__at"))
    files = (stored.select(F.col("_metadata.file_name").alias("__name"))
             .groupBy("__name").agg(F.count(F.lit(1)).alias("__n")))
    earlier = Window.orderBy("__name").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("__name", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return (rows.join(F.broadcast(files), F.col("__file") == F.col("__name"))
            .select(*stored.columns, (F.col("__before") + F.col("__at") + 1).alias(position)))
