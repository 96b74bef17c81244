"""High-watermark export: only rows above the last exported value of a column."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablelift.operators.layout import steady_numbers
from tablelift.operators.manifest import COMMITTED, Manifest, latest
from tablelift.operators.sinks import Published, export_frame, export_slices
from tablelift.operators.slices import Slice
from tablelift.options import ExportOptions
from tablelift.session import fresh_dir
from tablelift.storage import Store

log = logging.getLogger("tablelift")

SALTS = 32
# Missing keys are broadcast up to this many and this size as text.
BROADCAST_KEYS = 1_000_000
BROADCAST_BYTES = 16 * 1024 * 1024


def export_new_rows(
    df: DataFrame, column: str, target: str, options: ExportOptions, manifest: Manifest, name: str
) -> Published | None:
    """Export the rows above the stored watermark, up to the highest value now; see
    ``export_new_slices``, of which this is the one without slices."""
    done = export_new_slices(df, column, target, options, manifest, name)
    return done[0] if done else None


def export_new_slices(
    df: DataFrame, column: str, target: str, options: ExportOptions, manifest: Manifest, name: str,
    slicer: Callable[[DataFrame], list[Slice]] | None = None,
) -> list[Published]:
    """Export the rows above the stored watermark, up to the highest value now.

    The upper bound is fixed first, so rows that arrive meanwhile wait for the
    next run and ties at the bound are exported once. Each run owns the folder of
    its number: a run that died before its commit is written over, not repeated.
    The first run takes rows without a value too. With a ``slicer`` the new rows are cut
    into its slices, which are exported from one scan and committed together: the watermark
    moves when all are there, and not if they leave rows out or keep some twice, unless
    that is allowed. Nothing is returned if there is nothing new.
    """
    number, last = committed_watermark(manifest, name)
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    fresh = df if last is None else df.where(value > mark_value(last, kind))
    high = fresh.agg(mark_text(F.max(value), kind).alias("high")).first().high
    # Runs so far tell a first run, which a mark does not: its rows may all have had no value.
    if high is None and number:
        return []
    new = value <= mark_value(high, kind)
    fresh = fresh.where(new if number else new | value.isNull())
    key = {"job_id": name, "table": name, "partition_id": f"increment-{number:05d}", "file_index": 0}
    item = manifest.open_work([key])[0]
    manifest.start([item])
    folder = f"{target.rstrip('/')}/increment-{number:05d}"
    wanted = replace(options, mode="overwrite")
    try:
        if slicer is None:
            done = [export_frame(fresh, folder, wanted, df)]
        else:
            # What a run that died has left may be of slices that are no more.
            Store(df.sparkSession, folder).delete(folder)
            slices = slicer(fresh)
            done = export_slices(fresh, slices, folder, wanted, df, whole=slices)
            _check_coverage(fresh, done, options)
    except Exception as error:
        manifest.append([manifest.failed(item, str(error))])
        raise
    facts = {
        "row_count": sum(out.rows for out in done), "bytes_compressed": sum(out.bytes for out in done), "watermark": high,
    }
    manifest.append(manifest.finish(item, object_path=folder, **facts))
    return done


def _check_coverage(fresh: DataFrame, done: list[Published], options: ExportOptions) -> None:
    total = next((out.rows_of_source for out in done if out.rows_of_source is not None), None)
    total = fresh.count() if total is None else total
    none, several = total - sum(out.rows_first for out in done), sum(out.rows_several for out in done)
    if none or several:
        text = f"{none} rows are in no slice, {several} in several"
        if not options.allow_uncovered:
            raise ValueError(text)
        log.warning(text)


def mark_text(value: Column, kind: T.DataType) -> Column:
    """A watermark as stored text. Of a zoned timestamp the instant is kept, in
    microseconds, as its text would mean another one in another session zone."""
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def mark_value(text: str | None, kind: T.DataType) -> Column:
    """A stored watermark as a value of the column."""
    if isinstance(kind, T.TimestampType) and isinstance(text, str) and re.fullmatch(r"-?\d+", text):
        return F.timestamp_micros(F.lit(int(text)))
    return F.lit(text).cast(kind)


def committed_watermark(manifest: Manifest, name: str) -> tuple[int, str | None]:
    """(number of committed increments, watermark of the last that has one)."""
    number = F.regexp_extract("partition_id", r"(\d+)$", 1).cast("long")
    done = latest(manifest.records().where(F.col("job_id") == name))
    found = (
        done.where(F.col("status") == COMMITTED)
        .agg(F.count(F.lit(1)).alias("n"), F.max_by("watermark", F.when(F.col("watermark").isNotNull(), number)).alias("mark"))
        .first()
    )
    return found.n, found.mark


def late_rows(
    source: DataFrame, exported: DataFrame, keys: list[str], column: str, watermark, salts: int = SALTS
) -> DataFrame:
    """Source rows at or below the watermark, or without a value, whose key was
    never exported.

    The missing keys come from one row per key on both sides, where a struct key
    counts NULL parts as equal. They are written down first, so that their size is
    known: few, as there should be, are broadcast and the source is not shuffled.
    Otherwise each is repeated per salt, which spreads the rows of a key with very
    many.
    """
    spark = source.sparkSession
    names = [f"`{k}`" for k in keys]
    key = F.struct(*[F.col(n) for n in names]).alias("__key")
    bound = mark_value(watermark, source.schema[column].dataType)
    below = source.where((F.col(f"`{column}`") <= bound) | F.col(f"`{column}`").isNull())
    wanted = below.select(key).distinct()
    known = exported.select(key).distinct()
    folder = fresh_dir(spark, "missing-keys")
    wanted.join(known, "__key", "left_anti").write.parquet(folder)
    missing = spark.read.parquet(folder)
    columns = [f"`{c}`" for c in source.columns]
    # As text, as what they take on disk is less than what they take in memory.
    size = missing.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json("__key")))).first()
    if size[0] <= BROADCAST_KEYS and (size[1] or 0) <= BROADCAST_BYTES:
        return (
            below.select("*", key).join(F.broadcast(missing), "__key", "left_semi").select(*columns)
        )
    numbers = F.array(*[F.lit(i).cast("long") for i in range(salts)])
    spread = missing.select("__key", F.explode(numbers).alias("__salt"))
    salted = steady_numbers(below, "__salt").select(
        *columns, key, F.pmod("__salt", F.lit(salts).cast("long")).alias("__salt")
    )
    return salted.join(spread, ["__key", "__salt"], "left_semi").select(*columns)
