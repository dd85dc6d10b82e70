"""A customer holding a third of all orders: AQE splits it between stored
tables and the rows are the plain join's."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.sources.store import PathStore
from ledgerlake.plans.silver import clean_customers, clean_orders, financial_orders
from ledgerlake.session import scratch_dir
from ledgerlake.sources.extracts import customers_extract, orders_extract


@pytest.fixture()
def skewed(spark):
    orders = financial_orders(clean_orders(orders_extract(spark, SF_SMALL)))
    hot = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3)) == 0
    orders = orders.withColumn("customer_id", F.when(hot, F.lit("1")).otherwise(F.col("customer_id")))
    customers = clean_customers(customers_extract(spark, SF_SMALL))
    return orders, customers


def test_stored_inputs_let_aqe_split_the_hot_key(spark, skewed):
    orders, customers = skewed
    root = scratch_dir(spark, "skew-test")
    store = PathStore(spark, root)
    store.write("o", orders.repartition(8))  # several map tasks to split along
    store.write("c", customers)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        # many small scan tasks: AQE splits a hot partition along map outputs
        "spark.sql.files.maxPartitionBytes": "2k",
        "spark.sql.files.openCostInBytes": "1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        o, c = spark.read.parquet(f"{root}/o"), spark.read.parquet(f"{root}/c")
        joined = o.join(c, "customer_id")
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
        assert len(rows) == orders.join(customers, "customer_id").count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
