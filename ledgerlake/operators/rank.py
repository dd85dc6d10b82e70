"""``rank()`` / ``dense_rank()`` over every row when groups are few and huge.

A plain ``Window.partitionBy(category)`` runs one task per group: with six
categories and billions of products, six tasks do all the work. Rank only
depends on how many values in the group are greater, so the work splits:

1. Count rows per distinct (group, value) -- a hash aggregate combined
   map-side, so a value shared by a third of all rows becomes one row per
   map task, and every later step sees each value once.
2. Range-partition the distinct values on (group, value desc). Spark's
   range partitioner samples the bounds and binary-searches them per row,
   and equal keys always land in the same partition, so ties never straddle
   buckets. Without an explicit count AQE merges adjacent ranges up to the
   advisory partition size, so the number of buckets follows the size of
   the distinct-value table. Merged partitions are still contiguous, ordered
   ranges: the bucket is the partition id, written with
   the values to the shared folder and read back by both following steps.
3. Rank the values inside each (group, bucket) with a window -- balanced
   partitions now -- and add the rows (rank) or distinct values
   (dense_rank) of the group's earlier buckets, taken from a per-bucket
   count table of at most buckets + groups rows.
4. Join the rank of each distinct value back to the rows on (group, value);
   AQE's skew-join split handles a value held by many rows.

Order: value descending, NULLs last (NULL values rank after all others).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (groups and values may be NULL)."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = term if cond is None else cond & term
    joined = left.join(renamed, cond, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], order_col: str,
                       rank_col: str, method: str = "rank",
                       buckets: int | None = None) -> DataFrame:
    """Add ``rank_col`` = rank/dense_rank of ``order_col`` desc within ``group_cols``.

    ``buckets`` fixes the number of range partitions; by default it is left
    to AQE (``spark.sql.shuffle.partitions`` ranges, merged to the advisory
    size), so each ranking task gets a right-sized slice of values.
    """
    if method not in ("rank", "dense_rank"):
        raise ValueError("method must be 'rank' or 'dense_rank'")
    g = list(group_cols)
    v = order_col
    vals = df.groupBy(*g, v).agg(F.count(F.lit(1)).alias("__n"))
    ordered = [F.col(c).asc_nulls_first() for c in g] + [F.col(v).desc_nulls_last()]
    if buckets is None:
        vals = vals.repartitionByRange(*ordered)
    else:
        vals = vals.repartitionByRange(max(1, buckets), *ordered)
    # Stored once: both reads below see the same bucket of every value,
    # whatever the planner reuses or AQE merges.
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "rank-buckets")
    vals = vals.withColumn("__b", F.spark_partition_id())
    vals.write.mode("overwrite").parquet(path)
    vals = spark.read.schema(vals.schema).parquet(path)

    # Rows and distinct values of the group in all earlier buckets.
    stats = vals.groupBy(*g, "__b").agg(F.sum("__n").alias("__rows"),
                                        F.count(F.lit(1)).alias("__vals"))
    before = (Window.partitionBy(*g).orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.select(*g, "__b",
                         F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__row_off"),
                         F.coalesce(F.sum("__vals").over(before), F.lit(0)).alias("__val_off"))

    # Rank inside the bucket: one row per distinct value.
    local = Window.partitionBy(*g, "__b").orderBy(F.col(v).desc_nulls_last())
    if method == "rank":
        within = F.coalesce(F.sum("__n").over(local.rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)) + 1
    else:
        within = F.row_number().over(local)
    ranked = vals.withColumn("__within", within)
    ranked = _null_safe_join(ranked, stats, g + ["__b"])
    off = "__row_off" if method == "rank" else "__val_off"
    ranks = ranked.select(*g, v, (F.col(off) + F.col("__within")).cast("int").alias(rank_col))
    return _null_safe_join(df, ranks, g + [v])
