"""Writing one result: stage the files, name them, publish the folder."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tablelift.operators.digest import digest_of, digest_parts, digest_text
from tablelift.operators.layout import (
    SAMPLE_ROWS,
    SIZE_TOLERANCE,
    fill_files,
    first_rows,
    fits_one_file,
    rows_for_size,
    rows_per_task,
    spread_slices,
)
from tablelift.functions.names import file_template, slice_target
from tablelift.operators.slices import (
    COVER_COLUMN,
    SLICE_COLUMN,
    Slice,
    count_slices,
    cover_code,
    measure_slices,
    with_slice_number,
)
from tablelift.operators.textform import read_options, text_lines, text_options, to_text
from tablelift.operators import arrow_files, pointer, zstd_text
from tablelift.options import ExportOptions
from tablelift.session import fresh_dir
from tablelift.sources.readback import read_export
from tablelift.storage import Store, hadoop_uri

# More files than this, on average below this part of the target, are merged, at
# most so many by one task.
MANY_FILES = 64
SMALL_FILE_SHARE = 16
MERGE_AT_MOST = 1_000
NO_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


@dataclass(frozen=True)
class Published:
    """What one slice of one task put out."""

    slice_id: str
    target: str
    rows: int
    bytes: int
    files: int
    # Where slices are held against each other: rows that no earlier slice keeps, those of
    # them that a later one keeps too, and, where it was counted, all rows of the source.
    rows_first: int | None = None
    rows_several: int | None = None
    rows_of_source: int | None = None
    # What the rows add up to, if asked for.
    digest: str | None = None


class Counted(NamedTuple):
    """Rows that were written, counted right below the write."""

    rows: int
    first: int | None = None
    several: int | None = None
    digest: str | None = None


def export_frame(
    df: DataFrame, target: str, options: ExportOptions, table: DataFrame | None = None
) -> Published:
    """Write ``df`` to the folder ``target``.

    ``table`` is the plain scan ``df`` comes from: few of its rows show how large a
    row is. If it is ``df`` itself, its rows are counted, which file footers
    answer, and fill whole files. Without it nothing runs before the write, as it
    could run a long query twice; files that come out too large are split after.
    """
    options = options.checked()
    spark = df.sparkSession
    target, options = _named(target, options)
    target = hadoop_uri(target, options.azure_account)
    store = Store(spark, target)
    _refuse_existing(store, target, options)
    if options.arrow_files:
        return _write_by_arrow(df, store, [target], options)[0]
    cap = rows_per_file(table, options)
    # zstd files are cut as they are written, so there is nothing to fill.
    if not _is_zstd_text(options):
        df = fill_files(df, table, cap, options)
    if _in_place(store, options):
        return _write_in_place(df, store, target, options, cap)
    with _Staging(store, target) as staging:
        if _is_zstd_text(options):
            counted = _stage_zstd(df, staging.data, options)
        else:
            counted = _stage(df, staging.data, options, cap, [None])[0]
            _tidy(spark, store, staging.data, options, cap or counted.rows, df.drop(COVER_COLUMN).schema)
        return _covered(publish(store, staging.data, "single", target, counted.rows, options), counted)


def verify_export(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, digest: str, one_line_rows: bool = False
) -> None:
    """An error unless the rows that can be read back are those the digest was taken of."""
    found = digest_of(read_export(spark, path, fmt, schema, one_line_rows))
    if found != digest:
        raise ValueError(f"the rows of {path} are not those that were exported: {found} and not {digest}")


def export_slices(
    df: DataFrame,
    slices: list[Slice],
    target: str,
    options: ExportOptions,
    table: DataFrame | None = None,
    numbered: DataFrame | None = None,
    whole: list[Slice] | None = None,
) -> list[Published]:
    """Write several slices of ``df``, each to its own folder, from one scan.

    ``numbered`` gives the rows with their slice number where the source reads
    by slices already. ``whole`` are all slices of the table: with them the write counts
    how they cover its rows.
    """
    options = options.checked()
    spark = df.sparkSession
    target, options = _named(target, options)
    target = hadoop_uri(target, options.azure_account)
    store = Store(spark, target)
    if len(slices) > 1 and options.arrow_files:
        return _slices_by_arrow(df, slices, target, options, store, table, numbered, whole)
    if len(slices) == 1 or _is_zstd_text(options) or _in_place(store, options):
        done = []
        for s in slices:
            part = df if s.predicate is None else df.where(s.predicate)
            if whole is not None:
                part = part.withColumn(COVER_COLUMN, cover_code(whole, whole.index(s)))
            out = export_frame(part, slice_target(target, s.id), options, table)
            done.append(replace(out, slice_id=s.id))
        return done
    targets = [slice_target(target, s.id) for s in slices]
    for folder in targets:
        _refuse_existing(store, folder, options)
    cap = rows_per_file(table, options)
    total = None
    if numbered is None:
        counts, disjoint, total, most = _slice_sizes(df, slices, table)
        numbered = with_slice_number(df, slices, disjoint, whole)
        numbered = spread_slices(numbered, counts, min(cap or most, most))
    done = []
    with _Staging(store, targets[0]) as staging:
        counted = _stage(numbered, staging.data, options, cap, list(range(len(slices))))
        for i, s in enumerate(slices):
            folder = f"{staging.data}/{SLICE_COLUMN}={i}"
            _tidy(spark, store, folder, options, cap or counted[i].rows, df.schema)
            out = publish(store, folder, s.id, targets[i], counted[i].rows, options)
            done.append(replace(_covered(out, counted[i]), rows_of_source=total))
    return done


def _named(target: str, options: ExportOptions) -> tuple[str, ExportOptions]:
    """The target's folder, and the options with the file name the target ends in."""
    folder, name = file_template(target)
    return folder, replace(options, name_template=name) if name else options


def rows_per_file(table: DataFrame | None, options: ExportOptions) -> int | None:
    """Row limit of a file: the given one, or what the size target allows.

    Rows from one file, a fixed number, are written in the wanted format; the
    growth from a quarter of them to all is what a row takes. What
    the sample misjudges, :func:`_tidy` puts right.
    """
    limits = [options.max_rows_per_file] if options.max_rows_per_file else []
    target = options.target_file_bytes
    sampled = table is not None and target and not _is_zstd_text(options)
    if sampled and not fits_one_file(table, options):
        sample = first_rows(table, SAMPLE_ROWS)
        rows = sample.count()
        few = rows // 4
        if few:
            growth = _sample_bytes(sample, options) - _sample_bytes(sample.limit(few), options)
            limits.append(rows_for_size(growth / (rows - few), target))
    return min(limits) if limits else None


def _sample_bytes(sample: DataFrame, options: ExportOptions) -> int:
    folder = fresh_dir(sample.sparkSession, "sample")
    _writer(sample, options, None, "overwrite").save(folder)
    store = Store(sample.sparkSession, folder)
    size, _ = store.usage(folder)
    store.delete(folder)
    return size


def publish(
    store: Store, staged: str, slice_id: str, target: str, rows: int, options: ExportOptions
) -> Published:
    """Name the staged files and put the folder in place of the target.

    The folder changes by renames: the old one goes aside, the new one comes in,
    and comes back out if that fails. An empty result leaves no files.
    """
    names = list(store.files(staged))
    append = options.mode == "append"
    start = _next_index(store.files(target), options) if append else 0
    if options.numbered_files is not False:
        final = [options.file_name(start + i) for i in range(len(names))]
        pairs = [(f"{staged}/{a}", f"{staged}/{b}") for a, b in zip(names, final)]
        store.rename_all(pairs, options.io_concurrency)
        names = final
    if not rows:
        if not append:
            store.delete(target)
        return Published(slice_id, target, 0, 0, 0)
    size, count = store.usage(staged)
    if append:
        store.mkdirs(target)
        pairs = [(f"{staged}/{n}", f"{target.rstrip('/')}/{n}") for n in names]
        try:
            store.rename_all(pairs, options.io_concurrency)
        except Exception:
            # Nothing of a failed append stays; names it did not bring in are others'.
            left = store.files(staged)
            for name in names:
                if name not in left:
                    store.delete(f"{target.rstrip('/')}/{name}")
            raise
    else:
        _swap(store, staged, target.rstrip("/"))
    return Published(slice_id, target, rows, size, count)


def _next_index(files: dict[str, int], options: ExportOptions) -> int:
    """The number after the highest of the numbered files."""
    pattern = re.escape(options.file_name(0)).replace("00000", r"(\d+)", 1)
    found = [int(m[1]) for m in (re.fullmatch(pattern, name) for name in files) if m]
    return max(found, default=-1) + 1


def _swap(store: Store, staged: str, target: str) -> None:
    parent = target.rsplit("/", 1)[0]
    store.mkdirs(parent)
    aside = None
    if store.exists(target):
        aside = f"{parent}/_replaced-{uuid.uuid4().hex}"
        store.rename(target, aside)
    try:
        store.rename(staged, target)
    except Exception:
        if aside:
            store.rename(aside, target)
        raise
    if aside:
        store.delete(aside)


class _Staging:
    """A hidden folder beside the target, gone when the export is over."""

    def __init__(self, store: Store, target: str):
        self._store = store
        parent = target.rstrip("/").rsplit("/", 1)[0]
        self._root = f"{parent}/_staging-{uuid.uuid4().hex}"
        self.data = f"{self._root}/data"

    def __enter__(self) -> _Staging:
        return self

    def __exit__(self, *_) -> None:
        self._store.delete(self._root)


def _refuse_existing(store: Store, target: str, options: ExportOptions) -> None:
    if options.mode == "errorifexists" and (store.files(target) and pointer.current(store, target) != []):
        raise FileExistsError(f"target {target} already has files")


def _is_zstd_text(options: ExportOptions) -> bool:
    return options.format != "parquet" and options.compression == "zstd"


def _in_place(store: Store, options: ExportOptions) -> bool:
    """Files are written below the target itself, and none is moved."""
    return not store.can_rename if options.in_place is None else options.in_place


def _write_in_place(df: DataFrame, store: Store, target: str, options: ExportOptions, cap: int | None) -> Published:
    """Write below the target itself, beside what is there, and then move its pointer.

    Names are unique. If the write fails the pointer stays, and so do the files it lists;
    files that it does not list, of this write or of one whose driver died, are not read
    and go with the next one. Two writes to one target must not run at the same time.
    """
    target = target.rstrip("/")
    before = pointer.settle(store, target)
    there = store.files(target)
    try:
        if _is_zstd_text(options):
            names, counted = _write_zstd(df, store, target, options)
            new = set(names)
        else:
            counted = _stage(df, target, replace(options, mode="append"), cap, [None])[0]
            new = store.files(target).keys() - there.keys()
    except Exception:
        pointer.put_aside(store, target, list(there))
        raise
    return _moved_to(store, target, before, new, counted, options)


def _moved_to(
    store: Store, target: str, before: list[str], new: set[str], counted: Counted, options: ExportOptions
) -> Published:
    """The target's pointer moved to new files, or with an append to these and those before."""
    if not counted.rows:
        new = set()
    stay = sorted(new | set(before)) if options.mode == "append" else sorted(new)
    if stay or store.exists(target):
        pointer.move(store, target, stay)
        pointer.put_aside(store, target, stay)
    if not stay:
        store.delete(target)
    sizes = store.files(target)
    out = Published("single", target, counted.rows, sum(sizes[n] for n in new), len(new))
    return _covered(out, counted)


def _write_by_arrow(df: DataFrame, store: Store, targets: list[str], options: ExportOptions) -> list[Published]:
    """Rows written by tasks below the targets themselves, then the pointers moved.

    With several targets the last column tells each row's. If the write fails no pointer
    moves, and what it wrote goes.
    """
    targets = [target.rstrip("/") for target in targets]
    before = [pointer.settle(store, target) for target in targets]
    there = [list(store.files(target)) for target in targets]
    several = (SLICE_COLUMN,) if len(targets) > 1 else ()
    df, found = _counted(df, list(range(len(targets))) if several else [None], options.digest)
    rows, header = df, ""
    if options.format != "parquet":
        rows, header = text_lines(df, options.format, several)
    elif several:
        rows = df.select(*[f"`{c}`" for c in df.columns if c not in several], *several)
    for module in (zstd_text, arrow_files):
        # The writer travels with the job, so executors need not have this package.
        cloudpickle.register_pickle_by_value(module)
    plan = arrow_files.ArrowFiles(
        folders=tuple(store.qualified(target) for target in targets), parquet=options.format == "parquet",
        header=header, suffix="." + options.file_name(0).split(".", 1)[1], codec=options.compression,
        level=options.zstd_level, max_rows=options.max_rows_per_file, max_bytes=options.target_file_bytes,
        row_group_bytes=options.row_group_bytes, dictionary=options.dictionary,
    )
    try:
        written = rows.mapInArrow(arrow_files.batch_writer(plan), arrow_files.WRITTEN_SCHEMA).collect()
    except Exception:
        for target, names in zip(targets, there):
            pointer.put_aside(store, target, names)
        raise
    new: list[set[str]] = [set() for _ in targets]
    for row in written:
        new[row.slice_no].add(row.file_name)
    return [
        _moved_to(store, target, before[i], new[i], counted, options)
        for i, (target, counted) in enumerate(zip(targets, found()))
    ]


def _slices_by_arrow(
    df: DataFrame, slices: list[Slice], target: str, options: ExportOptions, store: Store,
    table: DataFrame | None, numbered: DataFrame | None, whole: list[Slice] | None,
) -> list[Published]:
    targets = [slice_target(target, s.id) for s in slices]
    for folder in targets:
        _refuse_existing(store, folder, options)
    total = None
    if numbered is None:
        counts, disjoint, total, most = _slice_sizes(df, slices, table)
        numbered = with_slice_number(df, slices, disjoint, whole)
        tasks = max(len(slices), df.sparkSession.sparkContext.defaultParallelism)
        even = max(1, math.ceil(sum(counts) / tasks))
        numbered = spread_slices(numbered, counts, min(even, most))
    done = _write_by_arrow(numbered, store, targets, options)
    return [replace(out, slice_id=s.id, rows_of_source=total) for out, s in zip(done, slices)]


def _slice_sizes(
    df: DataFrame, slices: list[Slice], table: DataFrame | None
) -> tuple[list[int], bool, int, int]:
    """Rows of every slice, whether no row is in two, all rows, and those that one task takes."""
    if table is not None:
        return *count_slices(df, slices), rows_per_task(df, table)
    *counts, width = measure_slices(df, slices)
    return *counts, rows_per_task(df, table, width)


def _covered(out: Published, counted: Counted) -> Published:
    return replace(out, rows_first=counted.first, rows_several=counted.several, digest=counted.digest)


def _counted(df: DataFrame, slice_numbers: list, digest: bool = False) -> tuple[DataFrame, Callable[[], list[Counted]]]:
    """``df`` with its rows counted on the way, without the columns that serve to count,
    and what gives the counts after a write.

    The count must sit right below the write, where a task counts once however often
    it is retried.
    """
    seen = Observation()
    covers = COVER_COLUMN in df.columns
    counts = {}
    for i, number in enumerate(slice_numbers):
        own = F.lit(True) if number is None else F.col(SLICE_COLUMN) == number
        counts[f"rows_{i}"] = F.count_if(own)
        if covers:
            counts[f"first_{i}"] = F.count_if(own & (F.col(COVER_COLUMN) > 0))
            counts[f"several_{i}"] = F.count_if(own & (F.col(COVER_COLUMN) > 1))
        if digest:
            rows = df.drop(COVER_COLUMN, SLICE_COLUMN).schema
            for k, part in enumerate(digest_parts(rows, own)):
                counts[f"digest_{i}_{k}"] = part
    df = df.observe(seen, *[c.alias(name) for name, c in counts.items()]).drop(COVER_COLUMN)

    def found() -> list[Counted]:
        got = seen.get
        names = ("rows", "first", "several") if covers else ("rows",)
        out = [Counted(*[int(got.get(f"{n}_{i}") or 0) for n in names]) for i in range(len(slice_numbers))]
        if digest:
            texts = [digest_text([got.get(f"digest_{i}_{k}") for k in range(3)]) for i in range(len(out))]
            out = [counted._replace(digest=text) for counted, text in zip(out, texts)]
        return out

    return df, found


def _stage(
    df: DataFrame, folder: str, options: ExportOptions, cap: int | None, slice_numbers: list
) -> list[Counted]:
    """Write the files and return rows per slice number."""
    df, found = _counted(df, slice_numbers, options.digest)
    mode = "append" if options.mode == "append" else "overwrite"
    writer = _writer(df, options, cap, mode)
    if slice_numbers != [None]:
        writer = writer.partitionBy(SLICE_COLUMN)
    writer.save(folder)
    return found()


def _writer(df: DataFrame, options: ExportOptions, cap: int | None, mode: str):
    if options.format == "parquet":
        extra = {
            "parquet.block.size": str(options.row_group_bytes),
            "parquet.enable.dictionary": str(options.dictionary).lower(),
            "parquet.compression.codec.zstd.level": str(options.zstd_level),
        }
        kind = "parquet"
    else:
        extra = text_options(options.format, len(df.columns))
        kind = "json"
        if options.format != "json":
            kind = "csv"
            extra["header"] = "true"
        df = to_text(df, options.format)
    codec = "gzip" if _is_zstd_text(options) else options.compression
    writer = df.write.format(kind).mode(mode).options(**NO_MARKER, **extra, compression=codec)
    return writer.option("maxRecordsPerFile", cap) if cap else writer


def _stage_zstd(df: DataFrame, folder: str, options: ExportOptions) -> Counted:
    """Write the files and move those of successful tasks to the folder; returns their rows."""
    attempts = folder + "-attempts"
    store = Store(df.sparkSession, folder)
    written, counted = _write_zstd(df, store, attempts, options)
    store.mkdirs(folder)
    pairs = [(f"{attempts}/{name}", f"{folder}/{name}") for name in written]
    store.rename_all(pairs, options.io_concurrency)
    return counted


def _write_zstd(df: DataFrame, store: Store, folder: str, options: ExportOptions) -> tuple[list[str], Counted]:
    """Files of successful tasks, and their rows: one short row a file comes to the driver."""
    df, found = _counted(df, [None], options.digest)
    # The writer travels with the job, so executors need not have this package.
    cloudpickle.register_pickle_by_value(zstd_text)
    lines, header = text_lines(df, options.format)
    plan = zstd_text.ZstdFiles(
        folder=store.qualified(folder),
        header=header,
        suffix="." + options.file_name(0).split(".", 1)[1],
        level=options.zstd_level,
        max_rows=options.max_rows_per_file,
        max_bytes=options.target_file_bytes,
    )
    written = lines.mapInArrow(zstd_text.batch_writer(plan), zstd_text.WRITTEN_SCHEMA).collect()
    return [r.file_name for r in written], found()[0]._replace(rows=sum(r.row_count for r in written))


def _tidy(
    spark: SparkSession,
    store: Store,
    folder: str,
    options: ExportOptions,
    cap: int,
    schema: T.StructType,
) -> None:
    """Make good what the write could not know: an empty file of an empty first task
    goes, very many small files are merged, and files above the target are split."""
    sizes = store.files(folder)
    first = next(iter(sizes), None)
    if len(sizes) > 1 and sizes[first] == min(sizes.values()):
        if read_export(spark, f"{folder}/{first}", options.format, schema).isEmpty():
            store.delete(f"{folder}/{first}")
            del sizes[first]
    target = options.target_file_bytes
    if not target:
        return
    total = sum(sizes.values())
    by_rows = options.max_rows_per_file is not None
    if not by_rows and len(sizes) > MANY_FILES and total < len(sizes) * target / SMALL_FILE_SHARE:
        parts = max(math.ceil(total / target), math.ceil(len(sizes) / MERGE_AT_MOST))
        raw = _raw(spark, folder, list(sizes), options)
        _put_again(store, folder, list(sizes), raw.coalesce(parts), options, cap)
        sizes = store.files(folder)
    while cap > 1:
        big = {n: s for n, s in sizes.items() if s > SIZE_TOLERANCE * target}
        if not big:
            return
        raw = _raw(spark, folder, list(big), options)
        per_row = sum(big.values()) / max(1, raw.count())
        cap = min(cap - 1, rows_for_size(per_row, target))
        _put_again(store, folder, list(big), raw, options, cap)
        sizes = store.files(folder)


def _raw(spark: SparkSession, folder: str, names: list[str], options: ExportOptions) -> DataFrame:
    """Rows of staged files; text stays as it stands."""
    paths = [f"{folder}/{n}" for n in names]
    if options.format == "parquet":
        return spark.read.parquet(*paths)
    if options.format == "json":
        return spark.read.text(paths)
    texts = spark.read.options(**read_options(options.format, 2), header=True, multiLine=True)
    return texts.csv(paths)


def _put_again(
    store: Store, folder: str, names: list[str], raw: DataFrame, options: ExportOptions, cap: int
) -> None:
    """Write rows of staged files again, in place of those files."""
    again = f"{folder}/_again-{uuid.uuid4().hex}"
    if options.format == "json":
        lines = raw.write.options(**NO_MARKER, maxRecordsPerFile=cap)
        lines.text(again, compression=options.compression)
    else:
        _writer(raw, options, cap, "overwrite").save(again)
    for name in names:
        store.delete(f"{folder}/{name}")
    prefix = min(names)[: len("part-00000")]
    moves = [(f"{again}/{n}", f"{folder}/{prefix}-{n}") for n in store.files(again)]
    store.rename_all(moves, options.io_concurrency)
    store.delete(again)
