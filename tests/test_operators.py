"""Operators against brute-force / built-in equivalents on random data."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import (compare_counts, diff_counts, keep_latest, net_row_counts, rank_within_groups,
                                  running_total, top_n_per_group)


def _rows(seed, n=300):
    rnd = random.Random(seed)
    groups = ["a", "b", "c", None]
    out = []
    for i in range(n):
        g = rnd.choice(groups) if rnd.random() > 0.3 else "a"  # "a" is hot
        v = rnd.choice([None, 1, 2, 2, 3, 5, 5, 5, 8, 13]) if rnd.random() > 0.05 else None
        out.append((g, v, i % 7, f"p{rnd.randint(0, 5)}"))
    return out


SCHEMA = "g string, v int, t int, p string"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("method", ["rank", "dense_rank"])
@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_rank_within_groups_matches_window(spark, seed, method, buckets):
    df = spark.createDataFrame(_rows(seed), SCHEMA)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    fn = F.rank if method == "rank" else F.dense_rank
    expected = df.withColumn("r", fn().over(w))
    got = rank_within_groups(df, ["g"], "v", "r", method=method, buckets=buckets)
    assert got.count() == df.count()
    assert diff_counts(expected, got.select(*expected.columns)).first() == (0, 0)


@pytest.mark.parametrize("seed", [4, 5])
def test_keep_latest_matches_row_number_with_total_order(spark, seed):
    df = spark.createDataFrame(_rows(seed), SCHEMA)
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("t").desc_nulls_last(),
                                        F.col("p").desc_nulls_last())
    expected = (df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn"))
    got = keep_latest(df, ["g"], ["v"], tie_break=["t", "p"])
    assert got.columns == df.columns
    assert got.count() == expected.count() == df.select("g").distinct().count()
    assert diff_counts(expected, got).first() == (0, 0)


def test_keep_latest_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "newest-null"), (1, 5, "five"), (2, None, "only")],
                               "k int, ts int, tag string")
    got = {r.k: r.tag for r in keep_latest(df, ["k"], ["ts"]).collect()}
    assert got == {1: "five", 2: "only"}


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("x", 10), ("x", 9), ("x", 9), ("x", 8), ("y", 1)],
                               "g string, v int")
    got = top_n_per_group(df, ["g"], "v", 2, "r", "rank").orderBy("g", "r").collect()
    assert [(r.g, r.v, r.r) for r in got] == [("x", 10, 1), ("x", 9, 2), ("x", 9, 2), ("y", 1, 1)]
    dense = top_n_per_group(df, ["g"], "v", 2, "r", "dense_rank")
    assert dense.filter("g = 'x'").count() == 3


def test_diff_counts_equals_except_all(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, s string")
    b = spark.createDataFrame([(1, "a"), (2, None), (4, "d"), (4, "d")], "k int, s string")
    got = diff_counts(a, b, "a", "b").first()
    assert got == (a.exceptAll(b).count(), b.exceptAll(a).count()) == (2, 2)
    assert net_row_counts(a, a).count() == 0
    assert compare_counts(a, b, "a", "b").first() == (4, 4, 2, 2, 2)
    assert compare_counts(a.limit(0), a.limit(0)).first() == (0, 0, 0, 0, 0)


def test_running_total_last_value_is_group_total(spark):
    rows = [(g, m, float(i)) for g in "ab" for i, m in enumerate(["2024-01", "2024-02", "2024-03"])]
    df = spark.createDataFrame(rows, "g string, m string, v double")
    out = running_total(df, ["g"], "m", "v", "run")
    last = out.filter("m = '2024-03'").select("g", "run").orderBy("g").collect()
    totals = df.groupBy("g").agg(F.sum("v").alias("t")).orderBy("g").collect()
    assert [r.run for r in last] == [r.t for r in totals]


_rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]),
              st.one_of(st.none(), st.integers(min_value=-3, max_value=6))),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_rows_strategy, buckets=st.integers(min_value=1, max_value=9),
       method=st.sampled_from(["rank", "dense_rank"]))
def test_rank_within_groups_property(spark, rows, buckets, method):
    df = spark.createDataFrame(rows, "g string, v int")
    fn = F.rank if method == "rank" else F.dense_rank
    expected = df.withColumn("r", fn().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    got = rank_within_groups(df, ["g"], "v", "r", method=method, buckets=buckets)
    assert diff_counts(expected, got.select(*expected.columns)).first() == (0, 0)


def test_cluster_conf_sizes_partitions_to_data(spark):
    from conftest import SF_SMALL
    from ledgerlake.session import cluster_conf, stored_bytes

    def partitions(n, cores):
        return int(cluster_conf(n, cores)["spark.sql.shuffle.partitions"])

    for tb in (1, 10, 100, 1000):
        n = tb * 1024 ** 4
        reducers, split = partitions(n, 64), int(cluster_conf(n, 64)["spark.sql.files.maxPartitionBytes"])
        assert n / (reducers * (n / split)) > 60 * 1024  # bytes a shuffle block
    assert partitions(100 * 1024 ** 4, 8000) == 40960
    assert partitions(10 * 1024 ** 2, 64) == 128
    assert stored_bytes(spark, SF_SMALL) > 100_000


@pytest.mark.parametrize("advisory", ["2k", "8k"])
def test_rank_within_groups_with_aqe_merged_buckets(spark, advisory):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", "c"]), rnd.randint(0, 400)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int")
    expected = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    conf = {"spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory,
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "512"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        buckets = (df.groupBy("g", "v").count()
                   .repartitionByRange(F.col("g"), F.col("v").desc())
                   .select(F.spark_partition_id().alias("b")).distinct().count())
        assert buckets > 1  # AQE-sized ranges: several buckets, possibly merged
        got = rank_within_groups(df, ["g"], "v", "r")
        assert diff_counts(expected, got.select(*expected.columns)).first() == (0, 0)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rank_without_exchange_reuse(spark):
    from pyspark.sql import Window

    df = spark.range(20_000).selectExpr("id % 3 AS g", "(id * 7919) % 9001 AS v")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    conf = {"spark.sql.exchange.reuse": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.execution.rangeExchange.sampleSizePerPartition": "5"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = rank_within_groups(df, ["g"], "v", "r", buckets=40)
        assert diff_counts(want, got.select(*want.columns)).first() == (0, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
