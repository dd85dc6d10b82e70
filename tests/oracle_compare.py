"""Run a Spark query and its DuckDB oracle on the same tables and compare.

Checks: row count, column names, column types (Spark type mapped to the
DuckDB name) and the multiset of rows (order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_type_name(t: T.DataType) -> str:
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {
        T.StringType: "VARCHAR", T.LongType: "BIGINT", T.IntegerType: "INTEGER",
        T.DoubleType: "DOUBLE", T.DateType: "DATE", T.TimestampType: "TIMESTAMP",
        T.TimestampNTZType: "TIMESTAMP", T.BooleanType: "BOOLEAN",
    }.get(type(t), t.simpleString().upper())


def _norm(v):
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    return ("v", v)


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    spark_cols = df.columns
    spark_types = [spark_type_name(f.dataType) for f in df.schema.fields]
    srows = [tuple(_norm(v) if v is not None else None for v in r) for r in df.collect()]
    rel = con.sql(sql)
    duck_cols = rel.columns
    duck_types = [str(t) for t in rel.types]
    drows = [tuple(_norm(v) if v is not None else None for v in r) for r in rel.fetchall()]
    out = {"spark_rows": len(srows), "oracle_rows": len(drows)}
    out["columns_match"] = sorted(spark_cols) == sorted(duck_cols)
    if not out["columns_match"]:
        out["columns"] = (spark_cols, duck_cols)
        out["match"] = False
        return out
    stype = dict(zip(spark_cols, spark_types))
    dtype = dict(zip(duck_cols, duck_types))
    out["type_diffs"] = {c: (stype[c], dtype[c]) for c in spark_cols if stype[c] != dtype[c]}
    order = [duck_cols.index(c) for c in spark_cols]
    drows = [tuple(r[i] for i in order) for r in drows]
    s_sorted, d_sorted = sorted(srows, key=_key), sorted(drows, key=_key)
    out["values_match"] = s_sorted == d_sorted
    if not out["values_match"]:
        sset, dset = set(srows), set(drows)
        out["only_spark"] = sorted(sset - dset, key=_key)[:3]
        out["only_oracle"] = sorted(dset - sset, key=_key)[:3]
    out["match"] = (out["values_match"] and len(srows) == len(drows)
                    and not out["type_diffs"])
    return out
