"""How many rows go into a file, and how many files a result fills."""

from __future__ import annotations

import math
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F, types as T

from tablelift.operators.slices import SLICE_COLUMN
from tablelift.options import ExportOptions

SAMPLE_ROWS = 4_000
# Exports are hardly ever this many times larger than the scan they come from.
GROWTH = {"parquet": 4}
TEXT_GROWTH = 20
SALT_COLUMN = "__salt"
# Rows are shuffled together when they fill so many times fewer files than tasks.
SPARSE_FACTOR = 4
# A size target is met when no file is larger than this share of it.
SIZE_TOLERANCE = 1.25
# Rows are set a little below the estimate, as rows differ in size.
SIZE_MARGIN = 0.9
# What a task takes of a shuffle, as it is in memory, whatever part of a file it fills.
TASK_BYTES = 256 * 1024 * 1024


def plan_size(df: DataFrame) -> int:
    """Bytes of a frame as the optimizer sees them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_one_file(df: DataFrame, options: ExportOptions) -> bool:
    """True if by the optimizer's size of ``df`` one file should hold it."""
    return plan_size(df) * GROWTH.get(options.format, TEXT_GROWTH) <= options.target_file_bytes


def first_rows(table: DataFrame, rows: int) -> DataFrame:
    """The first rows of one file of a scan.

    A limit starts every partition of its input, so the input is cut to a file
    first. A table without Parquet files hands a fixed number of rows over.
    """
    spark = table.sparkSession
    files = table._jdf.inputFiles()
    first = unquote(files[0]) if len(files) else ""
    if first.endswith(".parquet"):
        one = spark.read.parquet(first)
        if set(table.columns) <= set(one.columns):
            return one.select(*[f"`{c}`" for c in table.columns]).limit(rows)
    return spark.createDataFrame(table.take(rows), table.schema).coalesce(1)


def rows_for_size(bytes_per_row: float, target_bytes: int) -> int:
    return max(1, int(SIZE_MARGIN * target_bytes / max(bytes_per_row, 1e-6)))


def rows_per_task(df: DataFrame, table: DataFrame | None, width: float | None = None) -> int:
    """Rows of ``df`` that one task takes of a shuffle, where a file may hold any number.

    A few rows of the table show how wide a row is: as JSON, and eight bytes a column.
    Without a table it is the given width, or what the types tell.
    """
    if table is not None:
        text = F.to_json(F.struct("*"))
        width = first_rows(table, SAMPLE_ROWS).agg(F.avg(F.octet_length(text))).first()[0]
    if width is None:
        width = df._jdf.schema().defaultSize()
    return max(1, int(TASK_BYTES / (width + 8 * len(df.columns))))


def has_shuffle(df: DataFrame) -> bool:
    """True if rows come through a shuffle; a broadcast leaves a scan's order alone."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.search(r"(?<!Broadcast)(?<!Reused)Exchange ", plan) is not None


def steady_numbers(df: DataFrame, alias: str) -> DataFrame:
    """Number the rows of every partition in a way that a repeated task repeats.

    A scan gives its rows in one order. Rows that came through a shuffle may come
    in another when a task runs again after a lost executor, so they are sorted
    by their content first; equal rows may change places.
    """
    if has_shuffle(df):
        content = [
            F.to_json(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
        df = df.sortWithinPartitions(F.xxhash64(*content), F.sha2(F.to_json(F.struct(*content)), 256))
    return df.withColumn(alias, F.monotonically_increasing_id())


def spread_slices(df: DataFrame, slice_rows: list[int], cap: int) -> DataFrame:
    """Bring each slice's rows together, a large slice over a task for every ``cap`` rows.

    The salt counts rows off one by one, so neither a slice that holds most rows
    nor equal rows in any number end up in one task.
    """
    files = [max(1, math.ceil(rows / max(1, cap))) for rows in slice_rows]
    first = [sum(files[:i]) for i in range(len(files))]
    per_slice = F.get(F.array(*map(F.lit, files)), F.col(SLICE_COLUMN))
    offset = F.get(F.array(*map(F.lit, first)), F.col(SLICE_COLUMN))
    numbered = steady_numbers(df, SALT_COLUMN)
    place = (offset + F.pmod(SALT_COLUMN, per_slice)).cast("int")
    return (
        numbered.withColumn(SALT_COLUMN, place)
        .repartitionById(sum(files), F.col(SALT_COLUMN))
        .drop(SALT_COLUMN)
    )


def fill_files(
    df: DataFrame, table: DataFrame | None, cap: int | None, options: ExportOptions
) -> DataFrame:
    """Fewer and fuller files, where the number of rows is cheap to know.

    A whole table is counted from file footers, and its scan partitions are merged
    without a shuffle. A filtered one is counted over the filter's columns, and
    the few rows a selective filter leaves are shuffled together; merging its scan
    partitions would leave the scan itself to few tasks. No task takes more of a shuffle
    than TASK_BYTES, so that files of many rows are not full. ``even_files`` deals the
    rows out in any case. What a query or a table without files gives is left as
    it comes, as counting it would read it twice.
    """
    cheap = table is not None and len(table._jdf.inputFiles()) > 0
    if not cap or not (options.even_files or cheap):
        return df
    rows = df.count()
    wanted = max(1, math.ceil(rows / cap))
    if options.even_files:
        return df.repartition(max(wanted, math.ceil(rows / rows_per_task(df, table))))
    if df is table:
        return df.coalesce(wanted)
    partitions = df._jdf.rdd().getNumPartitions()
    if wanted * SPARSE_FACTOR < partitions:
        tasks = max(wanted, math.ceil(rows / rows_per_task(df, table)))
        return df.repartition(tasks) if tasks < partitions else df
    return df
