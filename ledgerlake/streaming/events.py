"""Sales events: gold rows -> JSON messages -> consumed JSON lines.

Publish (T1, D24) is a batch DataFrame write: one JSON object per gold row
in a ``value`` column, to Kafka when the connector is on the classpath
(``fmt="kafka"``) or to a text folder that plays the topic (tests, here).

Consume (T2-T4, D25) is a Structured Streaming query: read the topic,
decode ``value`` with an explicit schema, append JSON lines to a file sink.
``trigger(availableNow=True)`` drains what is there and stops (the bounded
drain), and the checkpoint records the position, so a second run appends
nothing (exactly-once into the file sink). ``maintain_latest`` keeps one row per
event id in a catalog table instead, batch by batch.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake.operators.latest import keep_latest
from ledgerlake.schemas import EVENT_ID_PREFIX, EVENT_TYPE, SALES_EVENT
from ledgerlake.sources.landing import export_csv, scan_csv, whole_lines
from ledgerlake.sources.store import CatalogStore

# When a message was published (ns since the epoch, one value per publish).
PUBLISHED = "published_at"
LOGGED_EVENT = StructType([*SALES_EVENT.fields, StructField(PUBLISHED, LongType())])

EXPORT_COLUMNS = ["sales_month", "category", "order_count", "total_quantity", "total_revenue"]


def gold_extract(gold_monthly: DataFrame) -> DataFrame:
    """S4 + P33: the five exported columns, ``order_month`` renamed."""
    return gold_monthly.select(F.col("order_month").alias("sales_month"), "category",
                               "order_count", "total_quantity", "total_revenue")


def build_events(extract: DataFrame) -> DataFrame:
    """Typed event fields (revenue becomes double, as in the feed).

    Works on the typed gold extract (S4) and on its all-text CSV copy (S5):
    counts are cast to bigint and revenue to double either way."""
    return extract.select(
        F.concat(F.lit(EVENT_ID_PREFIX + "-"), F.col("sales_month"), F.lit("-"),
                 F.col("category")).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.col("sales_month"),
        F.col("category"),
        F.col("order_count").cast("bigint").alias("order_count"),
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
    )


def encode(events: DataFrame) -> DataFrame:
    """One JSON message per event in ``value`` (NULL fields kept)."""
    return events.select(
        F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))


def decode(messages: DataFrame, mode: str = "FAILFAST",
           schema: StructType = SALES_EVENT) -> DataFrame:
    """``value`` (string or Kafka bytes) back to the typed event fields."""
    parsed = F.from_json(F.col("value").cast("string"), schema, {"mode": mode})
    return messages.select(parsed.alias("e")).select("e.*")


def publish(events: DataFrame, topic: str, fmt: str = "text",
            options: dict[str, str] | None = None) -> int:
    """K5 + Q5: write every event as one message; returns the number sent.

    ``fmt="kafka"`` needs ``kafka.bootstrap.servers`` in ``options`` and
    ``topic`` is the topic name; ``fmt="text"`` appends a JSON-lines folder.
    The count is observed on the write itself (no second job). Messages carry
    the time of the publish, so a later copy of an event can be told from an
    earlier one however the topic is drained.
    """
    obs = Observation(f"published-{uuid.uuid4().hex[:8]}")
    stamped = events.withColumn(PUBLISHED, F.lit(time.time_ns()).cast("bigint"))
    msgs = encode(stamped).observe(obs, F.count(F.lit(1)).alias("events"))
    if fmt == "kafka":
        msgs.write.format("kafka").options(**(options or {})).option("topic", topic).save()
    else:
        msgs.write.mode("append").format(fmt).options(**(options or {})).save(topic)
    return int(obs.get["events"])


def export_gold_csv(gold_monthly: DataFrame, path: str) -> None:
    """K4: the five exported columns as a header CSV, ``order_month`` renamed
    to ``sales_month`` (a distributed write, not a driver fetch)."""
    export_csv(gold_monthly.select("order_month", "category", "order_count",
                                   "total_quantity", "total_revenue"),
               path, rename={"order_month": "sales_month"})


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported CSV read back by its header; every value is text until
    P28 casts."""
    return whole_lines(scan_csv(spark, path, EXPORT_COLUMNS)).select(*EXPORT_COLUMNS)


def _topic(spark: SparkSession, topic: str, fmt: str, options: dict[str, str] | None) -> DataFrame:
    """The topic as a stream of messages, from its beginning."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.option("subscribe", topic).option("startingOffsets", "earliest").load()
    return reader.load(topic)


def consume(spark: SparkSession, topic: str, sink_path: str, checkpoint: str,
            fmt: str = "text", options: dict[str, str] | None = None) -> StreamingQuery:
    """S6 + K6: drain the topic into a JSON-lines sink and stop."""
    return (decode(_topic(spark, topic, fmt, options), schema=LOGGED_EVENT).writeStream
            .format("json")
            .outputMode("append")
            .option("path", sink_path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_log(spark: SparkSession, sink_path: str) -> DataFrame:
    """The raw log: consumed events with their publish time, every copy (the
    sink's committed files only)."""
    return spark.read.schema(LOGGED_EVENT).json(sink_path)


def read_consumed(spark: SparkSession, sink_path: str) -> DataFrame:
    """The consumed JSON lines as typed events."""
    return read_log(spark, sink_path).drop(PUBLISHED)


def _latest(log: DataFrame) -> DataFrame:
    return keep_latest(log, ["event_id"], [PUBLISHED], tie_break=[
        "order_count", "total_quantity", "total_revenue", "event_type", "sales_month",
        "category"])


def latest_events(log: DataFrame) -> DataFrame:
    """Weekly runs re-send the same event ids with new totals; the raw log
    (``read_log``) keeps every copy. This keeps one row per ``event_id``:
    the copy published last, then the largest totals."""
    return _latest(log).drop(PUBLISHED)


LATEST = "latest_events"


def replace_latest(store: CatalogStore, batch: DataFrame, batch_id: int, name: str = LATEST,
                   stream: str = "") -> bool:
    """Merge one batch of logged events into the keyed table ``name`` (one row
    per event id, as ``latest_events``); says whether it changed anything.

    The table's new version and the id of the batch it holds are switched in
    one catalog operation, so a batch that is replayed (or replayed after a
    crash between the switch and the stream's own commit) is skipped. Batches
    are numbered anew by another ``stream`` (another checkpoint). The cost of a
    batch is the batch and the distinct ids, not the log.
    """
    done = store.properties(name)
    if done.get("stream") == stream and int(done.get("batch", -1)) >= batch_id:
        return False
    rows = batch.unionByName(store.read(name)) if store.has(name) else batch
    store.write(name, _latest(rows))
    store.publish([name], batch=batch_id, stream=stream)
    return True


def maintain_latest(spark: SparkSession, topic: str, store: CatalogStore, checkpoint: str,
                    fmt: str = "text", options: dict[str, str] | None = None,
                    name: str = LATEST) -> StreamingQuery:
    """T2/T4 + D25 as a table kept up to date: drain the topic, each batch
    merged by ``replace_latest``."""
    events = decode(_topic(spark, topic, fmt, options), schema=LOGGED_EVENT)
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()
    return (events.writeStream
            .foreachBatch(lambda batch, batch_id: replace_latest(store, batch, batch_id, name, stream))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_latest(store: CatalogStore, name: str = LATEST) -> DataFrame:
    """The keyed table's events."""
    return store.read(name).drop(PUBLISHED)
