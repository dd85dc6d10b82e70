"""Bronze (D1-D3): land the raw extracts as CSV, read them back all-string,
tag lineage, store as tables.

Landing files live under the shared checkpoint folder (``scratch_dir``), never
a machine-local temp folder, so every executor of a cluster can read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.concurrency import run_concurrently
from ledgerlake.schemas import EXTRACT_COLUMNS
from ledgerlake.session import scratch_dir
from ledgerlake.sources.landing import (BROKEN, LINEAGE, scan_csv, whole_lines, with_lineage,
                                        write_csv)
from ledgerlake.sources.store import KINDS, CatalogStore, PathStore

EXTRACT_FILES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "sales_orders": "sales_orders.csv",
}


def land(spark: SparkSession, extracts: dict[str, DataFrame],
         landing: str | None = None) -> tuple[str, dict[str, bool]]:
    """Write each extract as a header CSV folder ``<landing>/<file name>/``;
    returns the landing folder and which extracts hold line breaks (the others'
    files can be split inside by their readers)."""
    landing = landing or scratch_dir(spark, "landing")
    breaks = run_concurrently({name: (lambda name=name, df=df:
                                      write_csv(df, f"{landing}/{EXTRACT_FILES[name]}"))
                               for name, df in extracts.items()})
    return landing, {name: n > 0 for name, n in breaks.items()}


def land_extracts(spark: SparkSession, extracts: dict[str, DataFrame],
                  landing: str | None = None) -> str:
    """``land`` for readers that take any file."""
    return land(spark, extracts, landing)[0]


def scan_bronze(spark: SparkSession, landing: str, name: str, literal_source: bool = True,
                file_name: str | None = None, multi_line: bool = True) -> DataFrame:
    """One landed extract as text with ``source_file`` and load time; broken
    lines (see ``landing.scan_csv``) are still among the rows.

    Columns are taken by header name (any order; extra columns pass through,
    as in the reference), and the extract's expected columns must be there.
    ``literal_source=True`` tags rows with the extract's file name (as the
    reference does); ``False`` uses each row's real landed file name.
    ``file_name`` overrides the file or folder name under ``landing``.
    """
    file_name = file_name or EXTRACT_FILES[name]
    rows = scan_csv(spark, f"{landing}/{file_name}", EXTRACT_COLUMNS[name], multi_line)
    return with_lineage(rows, file_name if literal_source else None)


def read_bronze(spark: SparkSession, landing: str, name: str, literal_source: bool = True,
                file_name: str | None = None, multi_line: bool = True) -> DataFrame:
    """The whole lines of ``scan_bronze``."""
    return whole_lines(scan_bronze(spark, landing, name, literal_source, file_name, multi_line))


def store_bronze(store: PathStore | CatalogStore, rows: DataFrame, name: str) -> dict[str, int]:
    """Write a scanned extract in one pass as ``bronze_<name>`` and, its
    broken lines with their raw text, ``broken_<name>``; returns the counts."""
    kind = F.array(F.when(F.col(BROKEN).isNull(), "whole").otherwise("broken"))
    own = [c for c in rows.columns if c != BROKEN]
    return store.write_split(f"landed_{name}", rows.withColumn(KINDS, kind), {
        f"bronze_{name}": (["whole"], own), f"broken_{name}": (["broken"], [*LINEAGE, BROKEN])})


def broken_lines(store: PathStore | CatalogStore, names: list[str]) -> DataFrame:
    """Every line that was not whole: dataset, source_file, raw_line."""
    out = None
    for name in names:
        rows = store.read(f"broken_{name}").select(
            F.lit(name).alias("dataset"), "source_file", F.col(BROKEN).alias("raw_line"))
        out = rows if out is None else out.unionAll(rows)
    return out
