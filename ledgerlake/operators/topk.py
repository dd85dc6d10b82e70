"""Top-n per group with ties (``rank`` / ``dense_rank`` <= n).

Expressed as a window plus a filter on the rank so Catalyst inserts
``WindowGroupLimit``: a partial limit runs in every map task before the
shuffle, so a group of any size ships at most n rows (plus ties) per map
task to its reducer. Rank cuts may return more than n rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def with_rank(df: DataFrame, group_cols: Sequence[str], order_col: str, rank_col: str,
              method: str = "rank") -> DataFrame:
    """Rank every row inside its group by ``order_col`` descending."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(order_col).desc())
    return df.withColumn(rank_col, RANKERS[method]().over(w))


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_col: str, n: int,
                    rank_col: str, method: str = "rank") -> DataFrame:
    return with_rank(df, group_cols, order_col, rank_col, method).filter(F.col(rank_col) <= n)
