"""Incremental landing (S8, D1-D3): every landed file is loaded once.

The ledger is a table of loaded files (dataset, path, length, modification
time). A run lists the landing folder, takes the files the ledger does not
know, appends their rows to the dataset's bronze folder as one load, and
enters them in the ledger last. ``read_loaded`` reads only the loads the ledger
names: a run that dies between the two leaves rows nobody sees, and the next
run loads those files again under a new load id. A file that is replaced
(other length or time) counts as new; its earlier rows stay, as landed.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ledgerlake.sources.landing import BROKEN, LINEAGE, scan_csv

LEDGER_SCHEMA = ("load_id string, dataset string, path string, length bigint, "
                 "modified timestamp, rows bigint, broken bigint")


class Landing:
    """The loads of one landing area, kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        # an empty first entry, so that the folder is there to be read
        spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(f"{self.root}/ledger")

    def ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.root}/ledger")

    def new_files(self, dataset: str, folder: str) -> DataFrame:
        """(path, length, modified) of the files under ``folder`` that are not
        in the ledger; from the listing, no content is read."""
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
                  .select("path", "length", F.col("modificationTime").alias("modified")))
        known = self.ledger().filter(F.col("dataset") == dataset)
        same = [listed[c] == known[c] for c in ("path", "length", "modified")]
        return listed.join(known, same, "left_anti")

    def load(self, dataset: str, folder: str, required: list[str]) -> dict[str, int]:
        """Load what is new; returns files, rows and broken lines."""
        # names only, as many as the listing the driver makes for any scan
        files = self.new_files(dataset, folder).collect()
        if not files:
            return {"files": 0, "rows": 0, "broken": 0}
        load_id = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        paths = [f["path"] for f in files]
        rows = scan_csv(self.spark, paths, required)
        rows = rows.select("*", F.col("_metadata.file_path").alias("__path"),
                           F.col("_metadata.file_name").alias(LINEAGE[0]),
                           F.current_timestamp().alias(LINEAGE[1]))
        target = f"{self.root}/bronze_{dataset}/load_id={load_id}"
        rows.write.parquet(target)
        stored = self.spark.read.schema(rows.schema).parquet(target)
        counts = stored.groupBy("__path").agg(F.count_if(F.col(BROKEN).isNull()).alias("rows"),
                                              F.count_if(F.col(BROKEN).isNotNull()).alias("broken"))
        listed = self.spark.createDataFrame(files)
        # a scan and the listing write a path's scheme differently (file:/a, file:///a)
        plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
        entry = listed.join(counts, plain(F.col("path")) == plain(F.url_decode(F.col("__path"))), "left").select(
            F.lit(load_id).alias("load_id"), F.lit(dataset).alias("dataset"), "path", "length", "modified",
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce("broken", F.lit(0)).cast("bigint").alias("broken"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")  # one file: all of it or nothing
        total = self.ledger().filter(F.col("load_id") == load_id).agg(
            F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("broken").alias("broken"))
        return total.first().asDict()

    def read_loaded(self, dataset: str, columns: list[str], broken: bool = False) -> DataFrame:
        """The rows of all loads in the ledger: ``columns`` and lineage, or the
        raw text of the broken lines."""
        loads = self.ledger().filter(F.col("dataset") == dataset).select(
            F.col("load_id").alias("__load")).distinct()
        schema = StructType()
        for c in [*columns, BROKEN, LINEAGE[0]]:
            schema = schema.add(c, StringType())
        schema = schema.add(LINEAGE[1], "timestamp").add("load_id", StringType())
        if self.ledger().filter(F.col("dataset") == dataset).isEmpty():
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/bronze_{dataset}")
        # a row a load: the join prunes the folders that are not in the ledger
        rows = rows.join(F.broadcast(loads), F.col("load_id") == F.col("__load"), "left_semi")
        if broken:
            return rows.filter(F.col(BROKEN).isNotNull()).select(*LINEAGE, F.col(BROKEN).alias("raw_line"))
        return rows.filter(F.col(BROKEN).isNull()).select(*columns, *LINEAGE)
