from ledgerlake.sources.extracts import (customers_extract, orders_extract,
                                        products_extract, raw_extracts, read_table)
from ledgerlake.sources.landing import (export_csv, scan_csv, source_manifest, whole_lines,
                                        with_lineage, write_csv)
from ledgerlake.sources.store import CatalogStore, PathStore

__all__ = [
    "customers_extract", "orders_extract", "products_extract", "raw_extracts",
    "read_table", "export_csv", "scan_csv", "source_manifest", "whole_lines", "with_lineage",
    "write_csv", "CatalogStore", "PathStore",
]
