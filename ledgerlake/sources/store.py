"""Where the layers' tables go: a folder per run, or versions in a catalog.

Both stores write a table once, with metrics that ride on the write, and read
it back by name; ``write_split`` writes one frame in one pass as several tables.

``PathStore``: plain folders under one root.

``CatalogStore``: overwriting a managed table without a gap. Every write makes
a new managed table (``<name>__<run>``) that nobody else knows; ``publish``
then points the view ``<name>`` at it in one catalog operation. With ``buckets``
set, tables written with ``bucket_by`` are bucketed and sorted by that column,
so joins on it need no shuffle; the price is a shuffle on the write in which one
hot key is one task, and a join whose hot key AQE can't split. Leave it unset
where a key may hold a large share of the rows. A reader of
``spark.table("<namespace>.<name>")`` sees the old rows or the new ones, never
none or half, and a failed run changes nothing. The version that was current
before stays for readers that have begun (``keep`` of them); older ones are
dropped after the switch. ``sweep`` drops versions that failed runs left.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KINDS, KIND = "row_kinds", "row_kind"


def _observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    obs = Observation(f"write-{uuid.uuid4().hex[:12]}")
    return df.observe(obs, *[c.alias(name) for name, c in metrics.items()]), obs


# the kinds of rows a part of a split holds, and its columns
Part = tuple[Sequence[str], Sequence[str]]


def _split(df: DataFrame, parts: Mapping[str, Part], metrics: Mapping[str, Column] | None):
    """Observe the rows of ``df``, then one row for each of its ``KINDS``."""
    kinds = sorted({k for held, _ in parts.values() for k in held})
    counts = {f"{k}_rows": F.count_if(F.array_contains(KINDS, k)) for k in kinds}
    df, obs = _observed(df, {"rows": F.count(F.lit(1)), **counts, **(metrics or {})})
    return df.withColumn(KIND, F.explode(KINDS)).drop(KINDS), obs


def _written(obs: Observation) -> dict[str, int]:
    return {name: int(value) for name, value in obs.get.items()}


class PathStore:
    """Tables as folders under ``root``; every ``read`` is a fresh scan."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        # name -> (folder, schema, kinds of its rows if it is part of a split, columns)
        self._known: dict[str, tuple[str, StructType, list[str] | None, list[str]]] = {}

    def _save(self, writer: DataFrameWriter, name: str) -> str:
        path = f"{self.root}/{name}"
        writer.format(self.fmt).mode("overwrite").save(path)
        return path

    def write(self, name: str, df: DataFrame, metrics: Mapping[str, Column] | None = None,
              partition_by: Sequence[str] = (), bucket_by: str | None = None) -> dict[str, int]:
        """K1 + Q2: overwrite table ``name``; returns its observed metrics, the
        row count first. Folders hold no buckets: ``bucket_by`` is for catalogs."""
        df, obs = _observed(df, {"rows": F.count(F.lit(1)), **(metrics or {})})
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        self._known[name] = (self._save(writer, name), df.schema, None, df.columns)
        return _written(obs)

    def write_split(self, name: str, df: DataFrame, parts: Mapping[str, Part],
                    metrics: Mapping[str, Column] | None = None,
                    bucket_by: str | None = None) -> dict[str, int]:
        """Write ``df`` in one pass: a row goes to every kind in its ``KINDS``
        array (a row without one goes nowhere); ``parts`` names the tables, the
        kinds they hold and their columns."""
        df, obs = _split(df, parts, metrics)
        path = self._save(df.write.partitionBy(KIND), name)
        for part, (kinds, columns) in parts.items():
            self._known[part] = (path, df.schema, list(kinds), list(columns))
        return _written(obs)

    def has(self, name: str) -> bool:
        return name in self._known

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        if name not in self._known:
            return reader.load(f"{self.root}/{name}")
        path, schema, kinds, columns = self._known[name]
        df = reader.schema(schema).load(path)
        if kinds is not None:
            df = df.filter(F.col(KIND).isin(kinds))
        return df.select(*columns)  # partition columns back in their place

    def publish(self, names: Iterable[str] | None = None) -> None:
        """Folders are visible as they are written."""


class CatalogStore:
    """Versioned managed tables of ``namespace`` behind views."""

    def __init__(self, spark: SparkSession, namespace: str, fmt: str = "parquet", keep: int = 1,
                 buckets: int | None = None, location: str | None = None):
        if not re.fullmatch(r"\w+(\.\w+)*", namespace):
            raise ValueError(f"not a namespace: {namespace!r}")
        self.spark, self.namespace, self.fmt, self.keep, self.buckets = spark, namespace, fmt, keep, buckets
        self.run = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
        self._pending: dict[str, tuple[str, str]] = {}  # name -> (version table, its select)
        create_namespace(spark, namespace, location)

    def _version(self, name: str) -> str:
        if not re.fullmatch(r"\w+", name) or "__" in name:
            raise ValueError(f"not a table name: {name!r}")
        return f"{self.namespace}.{name}__{self.run}"

    def _save(self, writer: DataFrameWriter, name: str, bucket_by: str | None) -> str:
        version = self._version(name)
        if bucket_by and self.buckets:
            writer = writer.bucketBy(self.buckets, bucket_by).sortBy(bucket_by)
        writer.format(self.fmt).mode("errorifexists").saveAsTable(version)
        return version

    def write(self, name: str, df: DataFrame, metrics: Mapping[str, Column] | None = None,
              partition_by: Sequence[str] = (), bucket_by: str | None = None) -> dict[str, int]:
        """K1 + Q2: as ``PathStore.write``, not visible before ``publish``.
        With the store's ``buckets`` set, the table is bucketed by ``bucket_by``."""
        df, obs = _observed(df, {"rows": F.count(F.lit(1)), **(metrics or {})})
        columns = ", ".join(f"`{c}`" for c in df.columns)
        if bucket_by and self.buckets:  # one file a bucket
            df = df.repartition(self.buckets, bucket_by)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        version = self._save(writer, name, bucket_by)
        self._pending[name] = (version, f"SELECT {columns} FROM {version}")
        return _written(obs)

    def write_split(self, name: str, df: DataFrame, parts: Mapping[str, Part],
                    metrics: Mapping[str, Column] | None = None,
                    bucket_by: str | None = None) -> dict[str, int]:
        """As ``PathStore.write_split``: one version table, a view for each part."""
        df, obs = _split(df, parts, metrics)
        if bucket_by and self.buckets:
            df = df.repartition(self.buckets, bucket_by)
        version = self._save(df.write.partitionBy(KIND), name, bucket_by)
        for part, (kinds, columns) in parts.items():
            held = ", ".join(f"'{k}'" for k in kinds)
            names = ", ".join(f"`{c}`" for c in columns)
            self._pending[part] = (version, f"SELECT {names} FROM {version} WHERE {KIND} IN ({held})")
        return _written(obs)

    def has(self, name: str) -> bool:
        return name in self._pending or self.spark.catalog.tableExists(f"{self.namespace}.{name}")

    def read(self, name: str) -> DataFrame:
        """This run's version of ``name``, else the published one."""
        if name in self._pending:
            return self.spark.sql(self._pending[name][1])
        return self.spark.table(f"{self.namespace}.{name}")

    def properties(self, name: str) -> dict[str, str]:
        """The published view's properties (none: nothing is published)."""
        full = f"{self.namespace}.{name}"
        if not self.spark.catalog.tableExists(full):
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}

    def publish(self, names: Iterable[str] | None = None, **properties: object) -> None:
        """Switch the views of ``names`` (all written ones) to this run's
        versions, each at once, then drop what is older than ``keep`` versions.

        The versions a view has had are kept in its properties, so only tables
        that were published and replaced are dropped, never another run's.
        """
        gone: set[str] = set()
        for name in list(self._pending if names is None else names):
            version, select = self._pending[name]
            full = f"{self.namespace}.{name}"
            if self.spark.catalog.tableExists(full) and \
                    self.spark.catalog.getTable(full).tableType != "VIEW":
                # a plain table from before versions: it becomes the oldest one
                self.spark.sql(f"ALTER TABLE {full} RENAME TO {full}__00000000000000000000_plain")
            had = [v for v in self.properties(name).get("versions", "").split(",") if v and v != version]
            kept = [version, *had[:self.keep]]
            stated = {**properties, "versions": ",".join(kept)}
            pairs = ", ".join(f"'{k}' = '{v}'" for k, v in stated.items())
            self.spark.sql(f"CREATE OR REPLACE VIEW {full} TBLPROPERTIES ({pairs}) AS {select}")
            gone.update(had[self.keep:])
            if names is not None:
                del self._pending[name]
        if names is None:
            self._pending.clear()
        for version in gone - self._referenced():
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
        self.run = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}" if not self._pending else self.run

    def _names(self) -> list[str]:
        return [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.namespace}").collect()
                if not r["isTemporary"]]

    def _referenced(self) -> set[str]:
        """Version tables that some view of the namespace still names (the
        parts of a split share one)."""
        held = {version for version, _ in self._pending.values()}
        for name in self._names():
            if "__" not in name:
                held.update(self.properties(name).get("versions", "").split(","))
        return held

    def sweep(self, older_than_seconds: float = 7 * 86400) -> list[str]:
        """Drop versions that no view names and that began longer ago (what
        failed runs left); returns their names."""
        held, limit = self._referenced(), time.time_ns() - int(older_than_seconds * 1e9)
        left = []
        for name in self._names():
            found = re.fullmatch(r"\w+?__(\d{20})_\w+", name)
            if found and f"{self.namespace}.{name}" not in held and int(found[1]) < limit:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.namespace}.{name}")
                left.append(name)
        return left


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """K2; ``location``: where its managed tables go (default: the warehouse)."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{place}")
