"""Landing round trip and the event feed (batch publish, streaming consume)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake import registry as R
from ledgerlake.operators import diff_counts
from ledgerlake.plans.bronze import land_extracts, read_bronze
from ledgerlake.session import scratch_dir
from ledgerlake.sources.extracts import raw_extracts
from ledgerlake.streaming import events as ev


def test_csv_landing_keeps_padding_and_nulls(spark):
    ex = raw_extracts(spark, SF_SMALL)
    landing = land_extracts(spark, ex)
    for name, df in ex.items():
        back = read_bronze(spark, landing, name)
        assert back.columns == df.columns + ["source_file", "ingestion_timestamp"]
        assert diff_counts(df, back.select(*df.columns)).first() == (0, 0), name
    real = read_bronze(spark, landing, "customers", literal_source=False)
    assert real.filter(F.col("source_file").endswith(".csv")).count() == ex["customers"].count()


def test_stream_consume_is_exactly_once(spark):
    events = R.q_sales_events(spark, SF_SMALL)
    root = scratch_dir(spark, "events-test")
    topic, sink, ckpt = f"{root}/topic", f"{root}/consumed", f"{root}/ckpt"
    ev.publish(events, topic)
    ev.consume(spark, topic, sink, ckpt).awaitTermination()
    first = ev.read_consumed(spark, sink)
    assert diff_counts(events, first).first() == (0, 0)
    # same checkpoint, nothing new published: the second drain adds nothing
    ev.consume(spark, topic, sink, ckpt).awaitTermination()
    assert ev.read_consumed(spark, sink).count() == events.count()
    # a re-publish (next weekly run) is appended; the latest view keeps one per id
    ev.publish(events, topic)
    ev.consume(spark, topic, sink, ckpt).awaitTermination()
    log = ev.read_consumed(spark, sink)
    assert log.count() == 2 * events.count()
    assert diff_counts(events, ev.latest_events(ev.read_log(spark, sink))).first() == (0, 0)


def test_json_envelope_round_trip(spark):
    events = R.q_sales_events(spark, SF_SMALL)
    back = ev.decode(ev.encode(events))
    assert diff_counts(events, back).first() == (0, 0)
    first = ev.encode(events).first().value
    assert first.startswith('{"event_id":"SALES-') and '"event_type":"MONTHLY_CATEGORY_SALES_READY"' in first


def test_bronze_reads_columns_by_header_name(spark):
    ex = raw_extracts(spark, SF_SMALL)["products"]
    landing = scratch_dir(spark, "landing-order")
    shuffled = ex.select(*reversed(ex.columns), F.lit("x").alias("extra_col"))
    shuffled.write.options(header="true", ignoreLeadingWhiteSpace="false",
                           ignoreTrailingWhiteSpace="false").csv(f"{landing}/products_500.csv")
    back = read_bronze(spark, landing, "products", file_name="products_500.csv")
    assert "extra_col" in back.columns
    assert diff_counts(ex, back.select(*ex.columns)).first() == (0, 0)
    assert back.select("source_file").distinct().first()[0] == "products_500.csv"


def test_latest_events_prefers_the_newer_publish(spark):
    events = R.q_sales_events(spark, SF_SMALL)
    root = scratch_dir(spark, "events-newer")
    topic, sink, ckpt = f"{root}/topic", f"{root}/consumed", f"{root}/ckpt"
    ev.publish(events, topic)
    # next week's run re-sends the same ids with smaller totals
    newer = events.withColumns({"order_count": F.col("order_count") - 1,
                                "total_revenue": F.col("total_revenue") - 1.0})
    ev.publish(newer, topic)
    ev.consume(spark, topic, sink, ckpt).awaitTermination()
    latest = ev.latest_events(ev.read_log(spark, sink))  # both drained together
    assert diff_counts(newer, latest.select(*newer.columns)).first() == (0, 0)


def test_gold_csv_is_read_by_its_header(spark):
    rows = spark.createDataFrame([("Books", "3", "2024-01", "9.5", "1")],
                                 "category string, total_quantity string, sales_month string, "
                                 "total_revenue string, order_count string")
    path = scratch_dir(spark, "gold-reordered")
    rows.write.mode("overwrite").option("header", "true").csv(path)
    assert tuple(ev.read_gold_csv(spark, path).first()) == ("2024-01", "Books", "1", "3", "9.5")


def test_keyed_table_skips_replayed_batches(spark):
    """Every batch once: a replay changes nothing, a new batch replaces its keys."""
    import uuid

    from ledgerlake.sources.store import CatalogStore

    name = f"keyed_{uuid.uuid4().hex[:10]}"
    root = scratch_dir(spark, "keyed")
    store = CatalogStore(spark, name, location=f"{root}/tables")
    events = R.q_sales_events(spark, SF_SMALL)
    logged = [events.withColumn("order_count", F.col("order_count") + n)
              .withColumn(ev.PUBLISHED, F.lit(n).cast("bigint")) for n in range(3)]
    part = F.col("category") < "M"
    assert ev.replace_latest(store, logged[0], 0) and ev.replace_latest(store, logged[1].filter(part), 1)
    once = ev.read_latest(store).collect()
    want = logged[0].filter(~part).unionByName(logged[1].filter(part)).drop(ev.PUBLISHED)
    assert diff_counts(want, ev.read_latest(store)).first() == (0, 0)
    for batch, i in ((logged[1].filter(part), 1), (logged[0], 0), (logged[2], 1)):
        assert not ev.replace_latest(store, batch, i)
    assert sorted(map(str, ev.read_latest(store).collect())) == sorted(map(str, once))
    # an older publish that arrives late does not win
    assert ev.replace_latest(store, logged[0], 2)
    assert diff_counts(want, ev.read_latest(store)).first() == (0, 0)
    # another stream numbers its batches anew
    assert ev.replace_latest(store, logged[2], 0, stream="next")
    assert not ev.replace_latest(store, logged[0], 0, stream="next")
    assert diff_counts(logged[2].drop(ev.PUBLISHED), ev.read_latest(store)).first() == (0, 0)
    # through a stream: drained, then nothing new
    topic, ckpt = f"{root}/topic", f"{root}/ckpt"
    store2 = CatalogStore(spark, f"{name}_s", location=f"{root}/tables_s")
    ev.publish(events, topic)
    for _ in range(2):
        ev.maintain_latest(spark, topic, store2, ckpt).awaitTermination()
        assert diff_counts(events, ev.read_latest(store2)).first() == (0, 0)
    assert store2.properties(ev.LATEST)["batch"] == "0"
    for schema in (name, f"{name}_s"):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
