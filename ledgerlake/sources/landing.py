"""The landing zone: CSV files in and out, every value as text.

Files follow RFC 4180: values may be quoted, a quote inside one is doubled,
line breaks, separators and backslashes inside quotes are text. An unquoted
nothing is NULL, a quoted nothing is the empty string. A line with more or
fewer values than the header is not guessed at: it comes with its raw text in
``BROKEN`` and can be written apart.

Quoted line breaks need ``multi_line`` (the default), which reads a file in one
task, so large extracts should be landed as many files; plain files without
quoted breaks can be split inside with ``multi_line=False``. A quote that is
opened and never closed takes the rest of its file into one value.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import all_string

BROKEN = "_broken_line"
LINEAGE = ("source_file", "ingestion_timestamp")
# stands for "no value" while a file is parsed, so that "" can be a value
_ABSENT = "\u0001"
_DIALECT = {
    "header": "true", "quote": '"', "escape": '"',
    # padding belongs to the values (both defaults strip on write)
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
_READ = {
    **_DIALECT, "mode": "PERMISSIVE", "nullValue": _ABSENT, "emptyValue": "",
    # every file's own header must name the columns of the scan
    "enforceSchema": "false",
    # a line can only be counted if all of it is parsed
    "columnPruning": "false",
}


def header_columns(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> list[str]:
    """Column names from the first line (no value is read, nothing inferred)."""
    return spark.read.options(**_READ, multiLine=multi_line).csv(path).columns


def scan_csv(spark: SparkSession, path: str | list[str], required: Iterable[str] = (),
             multi_line: bool = True) -> DataFrame:
    """The header's columns as strings plus ``BROKEN``: the raw text of a
    line whose number of values differs from the header's, else NULL.

    Raises if a ``required`` column is missing from the header; other columns
    pass through.
    """
    names = header_columns(spark, path, multi_line)
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return (spark.read.options(**_READ, multiLine=multi_line, columnNameOfCorruptRecord=BROKEN)
            .schema(all_string([*names, BROKEN])).csv(path))


def whole_lines(scanned: DataFrame) -> DataFrame:
    """The rows whose line had one value for each column."""
    # Spark refuses scans of which only the broken line is used (a bare count
    # would be one), so the test names the first column: nullif(x, x) is NULL
    first = F.col(scanned.columns[0])
    return scanned.filter(F.coalesce(F.col(BROKEN), F.nullif(first, first)).isNull()).drop(BROKEN)


def broken_only(scanned: DataFrame) -> DataFrame:
    """The other rows: their raw text in ``BROKEN``."""
    first = F.col(scanned.columns[0])
    return scanned.filter(F.coalesce(F.col(BROKEN), F.nullif(first, first)).isNotNull())


def with_lineage(df: DataFrame, file_label: str | None = None) -> DataFrame:
    """P2 + P3: where a row came from and when. Without ``file_label`` the name
    of the row's own file (file scans only)."""
    origin = F.col("_metadata.file_name") if file_label is None else F.lit(file_label)
    return df.select("*", origin.alias(LINEAGE[0]), F.current_timestamp().alias(LINEAGE[1]))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Land a frame as header CSV, padding preserved (one file per partition).

    Returns how many rows hold a line break, counted on the write: where there
    are none, the files can be read with ``multi_line=False``."""
    broken = [F.contains(F.col(c).cast("string"), F.lit(b)) for c in df.columns for b in "\n\r"]
    obs = Observation(f"landed-{uuid.uuid4().hex[:12]}")
    df = df.observe(obs, F.count_if(reduce(or_, broken)).alias("breaks"))
    df.write.mode(mode).options(**_DIALECT).csv(path)
    return int(obs.get["breaks"])


def export_csv(df: DataFrame, path: str, rename: dict[str, str] | None = None) -> None:
    """K4: gold extract to header CSV with column renames, distributed write."""
    if rename:
        df = df.withColumnsRenamed(rename)
    write_csv(df, path)


def source_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per landed file with its row count, size and mtime.

    Distributed: a group-by over the ``_metadata`` column of the CSV scan,
    so the rows of a landing folder of any size are never counted on the driver.
    """
    scan = spark.read.options(**_READ, multiLine=multi_line).csv(path)
    return (scan.select("_metadata.file_name", "_metadata.file_size",
                        "_metadata.file_modification_time")
            .groupBy("file_name", "file_size", "file_modification_time")
            .agg(F.count(F.lit(1)).alias("row_count")))
