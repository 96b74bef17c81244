"""Table export as Spark jobs: read tables or queries in slices, write
Parquet, CSV, TSV or JSON-lines files, and keep a manifest to resume from."""

from tablelift.options import ExportOptions

__all__ = ["ExportOptions"]
