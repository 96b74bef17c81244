"""Scans: projection, filter text, and reads pinned to one state of the files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelift.session import small_frame
from tablelift.storage import Store

# Bytes at the end of a pinned file that its digest is taken of.
TAIL_BYTES = 64 * 1024
STAT_THREADS = 16
SHOWN_FILES = 5


def scan(df: DataFrame, columns: list[str] | None = None, predicate: str | None = None) -> DataFrame:
    """Chosen columns in the given order (none: all) of the rows the predicate keeps."""
    if predicate is not None:
        df = df.where(F.expr(predicate))
    return df.select(*[f"`{c}`" for c in columns]) if columns else df


class PinnedFilesChanged(ValueError):
    """Files are not what they were when they were pinned."""


def pin_files(df: DataFrame, pin_dir: str) -> DataFrame:
    """Write down which files ``df`` reads now, so that later runs read the same.

    Slices of one run that share ``df`` see one state already, as its file list
    is fixed when it is made; the stored list carries that over to another run. With each
    path go the file's length, its modification time and a digest of its last bytes, where
    a Parquet file has its footer: what tells it from another file of that name.
    """
    spark = df.sparkSession
    paths = [unquote(path) for path in df.inputFiles()]
    rows = [(path, *(known or (None, None, None))) for path, known in zip(paths, _identities(spark, paths))]
    pinned = small_frame(spark, rows, "path string, length long, modified long, tail_sha256 string")
    pinned.write.mode("errorifexists").parquet(pin_dir)
    return spark.read.parquet(pin_dir)


def _identities(spark: SparkSession, paths: list[str]) -> list[tuple[int, int, str] | None]:
    return Store(spark, paths[0]).identities(paths, TAIL_BYTES, STAT_THREADS) if paths else []


def changed_files(spark: SparkSession, pin_dir: str) -> list[str]:
    """Pinned files that are gone, or that have other contents than when they were pinned."""
    rows = spark.read.parquet(pin_dir).collect()
    now = _identities(spark, [row.path for row in rows])
    return [row.path for row, known in zip(rows, now) if known != (row.length, row.modified, row.tail_sha256)]


def read_pinned(spark: SparkSession, pin_dir: str, schema) -> DataFrame:
    """The Parquet table as of :func:`pin_files`, or an error that names the files that changed.

    Only paths and identities of files pass the driver, as paths do in any file scan.
    """
    changed = changed_files(spark, pin_dir)
    if changed:
        shown = ", ".join(sorted(changed)[:SHOWN_FILES])
        raise PinnedFilesChanged(f"{len(changed)} pinned files have changed or are gone: {shown}")
    paths = [row.path for row in spark.read.parquet(pin_dir).toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
