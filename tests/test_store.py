"""Versioned tables: a switch without a gap, one write as several tables."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import diff_counts, in_stored_order, keyed_diff, sorted_rows
from ledgerlake.session import scratch_dir
from ledgerlake.sources.store import KINDS, CatalogStore, PathStore


@pytest.fixture
def namespace(spark):
    name = f"ns_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def tables(spark, namespace):
    return {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {namespace}").collect() if not r["isTemporary"]}


def test_publish_switches_and_keeps_one_version(spark, namespace):
    store = CatalogStore(spark, namespace)
    for n in (3, 5, 7, 9):
        assert store.write("t", spark.range(n).toDF("x"), {"odd": F.count_if(F.col("x") % 2 == 1)}) == {
            "rows": n, "odd": n // 2}
        assert store.read("t").count() == n  # the run sees its own version
        if n > 3:
            assert spark.table(f"{namespace}.t").count() == n - 2  # others the last one
        store.publish()
        assert spark.table(f"{namespace}.t").count() == n
    # the view, its version and the one before
    assert len(tables(spark, namespace)) == 3


def test_schema_may_change(spark, namespace):
    store = CatalogStore(spark, namespace)
    for df in (spark.range(3).toDF("x"), spark.range(2).selectExpr("'a' AS y", "id AS x")):
        store.write("t", df)
        store.publish()
        assert spark.table(f"{namespace}.t").columns == df.columns


def test_a_failed_run_changes_nothing_and_is_swept(spark, namespace):
    CatalogStore(spark, namespace).write("t", spark.range(3).toDF("x"))  # never published
    store = CatalogStore(spark, namespace)
    store.write("t", spark.range(4).toDF("x"))
    store.publish()
    assert spark.table(f"{namespace}.t").count() == 4
    assert store.sweep() == [] and len(store.sweep(0)) == 1
    assert spark.table(f"{namespace}.t").count() == 4 and len(tables(spark, namespace)) == 2


def test_a_plain_table_becomes_the_oldest_version(spark, namespace):
    store = CatalogStore(spark, namespace)
    spark.range(2).toDF("x").write.saveAsTable(f"{namespace}.t")
    store.write("t", spark.range(6).toDF("x"))
    store.publish()
    assert spark.table(f"{namespace}.t").count() == 6


def test_readers_never_fail_or_see_half(spark, namespace):
    """A reader in a loop over reruns sees whole versions only."""
    store = CatalogStore(spark, namespace)
    sizes = [1000 + i for i in range(6)]
    store.write("t", spark.range(sizes[0]).toDF("x").repartition(4))
    store.publish()
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.table(f"{namespace}.t").agg(F.count("x"), F.max("x")).first()))
            except Exception as e:  # noqa: BLE001
                errors.append(str(e))

    reader = threading.Thread(target=read)
    reader.start()
    for n in sizes[1:]:
        store.write("t", spark.range(n).toDF("x").repartition(4))
        store.publish()
    stop.set()
    reader.join()
    assert not errors and len(seen) > 3
    assert all(n in sizes and top == n - 1 for n, top in seen)


@pytest.mark.parametrize("catalog", [False, True])
def test_one_write_as_several_tables(spark, namespace, catalog):
    store = CatalogStore(spark, namespace) if catalog else PathStore(spark, scratch_dir(spark, "split"))
    kinds = F.array_compact(F.array(F.when(F.col("id") % 2 == 0, "even"), F.when(F.col("id") % 3 == 0, "third")))
    rows = spark.range(20).withColumn("s", F.col("id").cast("string")).withColumn(KINDS, kinds)
    got = store.write_split("base", rows, {"evens": (["even"], ["id"]), "both": (["even", "third"], ["id", "s"]),
                                           "none": (["never"], ["s"])}, {"big": F.count_if(F.col("id") > 15)})
    assert got == {"rows": 20, "even_rows": 10, "third_rows": 7, "never_rows": 0, "big": 4}
    store.publish()
    assert sorted(r[0] for r in store.read("evens").collect()) == list(range(0, 20, 2))
    assert store.read("both").count() == 17 and store.read("both").columns == ["id", "s"]
    assert store.read("none").count() == 0
    if catalog:  # a second run replaces the parts, the shared version stays while a part names it
        store.write_split("base", rows.filter("id < 2"), {"evens": (["even"], ["id"]), "both": (["even", "third"], ["id", "s"]),
                                                          "none": (["never"], ["s"])})
        store.publish()
        assert spark.table(f"{namespace}.evens").count() == 1 and spark.table(f"{namespace}.both").count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark, namespace):
    """J1 on tables bucketed by customer: no exchange below the join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = CatalogStore(spark, namespace, buckets=4)
        orders = spark.range(500).selectExpr("id AS order_id", "id % 40 AS customer_id").withColumn(
            KINDS, F.array(F.lit("good")))
        customers = spark.range(35).selectExpr("id AS customer_id", "concat('c', id) AS name")
        store.write_split("split", orders, {"orders": (["good"], ["order_id", "customer_id"])}, bucket_by="customer_id")
        store.write("customers", customers, bucket_by="customer_id")
        store.publish()
        joined = spark.table(f"{namespace}.orders").join(spark.table(f"{namespace}.customers"), "customer_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = orders.drop(KINDS).join(customers, "customer_id")
        assert diff_counts(want, joined.select(*want.columns)).first() == (0, 0)
        # without buckets both sides are shuffled, and AQE may split a hot key
        plain = want._jdf.queryExecution().executedPlan().toString()
        assert plain.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stored_order(spark):
    store = PathStore(spark, scratch_dir(spark, "order"))
    df = spark.range(5000).selectExpr("id % 7 AS g", "CASE WHEN id % 11 > 0 THEN (id * 7919) % 1000 END AS v", "id")
    store.write("t", sorted_rows(df.repartition(8), ["g", "v desc"]))
    got = [tuple(r)[:3] for r in sorted(in_stored_order(store.read("t")).collect(), key=lambda r: r["position"])]
    assert got == sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    assert {r["position"] for r in in_stored_order(store.read("t")).collect()} == set(range(1, 5001))
    plan = sorted_rows(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_keyed_diff(spark):
    schema = "k int, a int, b string, c decimal(9,2)"
    left = spark.createDataFrame([(1, 1, "x", None), (2, 2, None, None), (3, 3, "z", None), (4, 4, "q", None),
                                  (5, 5, "r", None), (5, 6, "r", None), (6, 1, "s", None), (6, 2, "s", None),
                                  (None, 1, "n", None)], schema)
    right = spark.createDataFrame([(2, 2, "y", None), (1, 1, "x", None), (3, 9, "w", None), (7, 7, "t", None),
                                   (5, 6, "r", None), (5, 5, "r", None), (6, 1, "s", None), (6, 3, "s", None),
                                   (None, 2, "n", None)], schema)
    got = {tuple(r) for r in keyed_diff(left, right, ["k"]).collect()}
    assert got == {(2, "b", None, "y"), (3, "a", "3", "9"), (3, "b", "z", "w"), (4, "(rows)", "1", "0"),
                   (7, "(rows)", "0", "1"), (6, "(rows)", "2", "2"), (None, "a", "1", "2")}
    assert keyed_diff(left, left.orderBy(F.col("a").desc()).repartition(3), ["k"]).count() == 0
    plan = keyed_diff(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
