"""Running a task list: tables side by side, slices in passes, results as rows."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tablelift.functions.names import single_target
from tablelift.operators.incremental import export_new_slices
from tablelift.operators.layout import plan_size
from tablelift.operators.manifest import COMMITTED, KEY_FIELDS, Manifest, latest
from tablelift.operators.sinks import Published, export_frame, export_slices, verify_export
from tablelift.operators.slices import SLICE_COLUMN, Slice, predicate_hash, single_slice, uncovered_rows
from tablelift.options import ExportOptions
from tablelift.plans.tasks import TABLE
from tablelift.session import small_frame
from tablelift.sources.tables import pin_files, read_pinned
from tablelift.storage import Store

log = logging.getLogger("tablelift")

RESULT_SCHEMA = (
    "task_id string, slice_id string, target string, status string, "
    "rows long, bytes long, files long, error string"
)
COMPLETED, FAILED, SKIPPED = "completed", "failed", "skipped"

Slicer = Callable[[Row, DataFrame], list[Slice]]


def run_job(
    source,
    tasks: DataFrame,
    options: ExportOptions,
    slicer: Slicer | None = None,
    job_id: str | None = None,
) -> DataFrame:
    """Export every task and return one result row per slice.

    Tasks run side by side on their own scheduler pools, the largest first, and one that
    fails does not stop the others. With a manifest, committed slices are skipped when
    the job is resumed, which needs the job's id. Only the task list is on the driver.

    Under ``high_watermark`` each task exports its rows above the job's last watermark,
    to a folder of this run, where the slices of the new rows have folders of their own. A sliced task fails if its slices do not keep each row once.
    """
    options = options.checked()
    spark = source.spark
    if job_id is None and (options.resume or options.consistency == "high_watermark"):
        raise ValueError("a job that goes on from an earlier run needs its job_id")
    if options.consistency == "high_watermark" and not (options.manifest_dir and options.watermark_column):
        raise ValueError("high_watermark needs a manifest_dir and a watermark_column")
    if slicer and options.consistency == "high_watermark" and hasattr(source, "sliced"):
        raise ValueError("a source that reads slices itself cannot slice what is above a watermark")
    job_id = job_id or uuid.uuid4().hex
    job = _Job(source, options, slicer, job_id)
    with ThreadPoolExecutor(max_workers=options.table_concurrency) as pool:
        planned = list(pool.map(job.plan, tasks.collect()))
        job.look_up(planned)
        if job.manifest and options.resume and job.manifest.file_count() > job.manifest.compact_at:
            job.manifest.compact()
        # A large table that starts last would run alone at the end.
        order = sorted(range(len(planned)), key=lambda i: -planned[i].size)
        done = dict(zip(order, pool.map(job.run, [planned[i] for i in order])))
        rows = [row for i in range(len(planned)) for row in done[i]]
    return small_frame(spark, rows, RESULT_SCHEMA)


def summary(results: DataFrame) -> DataFrame:
    """Totals of a run; a task is complete if none of its slices failed."""
    per_task = results.groupBy("task_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.sum("files").alias("files"),
        F.max(F.concat("task_id", F.lit(": "), "error")).alias("error"),
        F.bool_and(F.col("status") == SKIPPED).alias("skipped"),
    )
    failed = F.col("error").isNotNull()
    return per_task.agg(
        F.count_if(~failed & ~F.col("skipped")).alias("completed_tasks"),
        F.count_if(failed).alias("failed_tasks"),
        F.count_if(F.col("skipped")).alias("skipped_tasks"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_exported"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_written"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files_written"),
        F.sort_array(F.collect_list("error")).alias("errors"),
    )


def raise_on_failure(results: DataFrame) -> DataFrame:
    """The results, or an error that names what failed."""
    failed = results.where(F.col("status") == FAILED).select("task_id", "error").collect()
    if failed:
        raise RuntimeError("; ".join(f"{r.task_id}: {r.error}" for r in failed))
    return results


@dataclass
class _Planned:
    """A task with its slices, or the reason it has none."""

    task: Row
    table: DataFrame | None = None
    frame: DataFrame | None = None
    slices: list[Slice] = field(default_factory=list)
    error: Exception | None = None
    # Bytes to read, as the optimizer sees them.
    size: int = 0
    # Manifest entry of each slice still to do.
    open: dict[str, dict | None] = field(default_factory=dict)
    # What each slice was found to cover: (rows no earlier slice keeps, those several keep).
    covered: dict[str, tuple[int, int]] = field(default_factory=dict)
    # The slices that each is held against, if the predicates of all can be.
    whole: list[Slice] | None = None
    # Rows of the source, where a pass has counted them.
    total: int | None = None


class _Job:
    def __init__(self, source, options: ExportOptions, slicer: Slicer | None, job_id: str):
        self.source = source
        self.options = options
        self.slicer = slicer
        self.job_id = job_id
        self.manifest = None
        if options.manifest_dir:
            self.manifest = Manifest(source.spark, options.manifest_dir, job_id)

    def plan(self, task: Row) -> _Planned:
        try:
            table, frame = _task_frames(self.source, task, self.options, self.job_id)
            increments = self.options.consistency == "high_watermark"
            slices = self.slicer(task, frame) if self.slicer and not increments else single_slice()
            if task.kind == TABLE and hasattr(self.source, "check_slices"):
                self.source.check_slices(slices)
            return _Planned(task, table, frame, slices, size=plan_size(frame))
        except Exception as error:
            return _Planned(task, error=error)

    def look_up(self, planned: list[_Planned]) -> None:
        """Find out what is left to do, for all tasks with one read of the manifest."""
        for p in planned:
            p.open = {s.id: None for s in p.slices}
        if not self.manifest:
            return
        keys = [_slice_key(p.task, s, self.job_id) for p in planned for s in p.slices]
        by_key = {_identity(item): item for item in self.manifest.states(keys)} if keys else {}
        for p in planned:
            for s in p.slices:
                item = by_key[_identity(_slice_key(p.task, s, self.job_id))]
                if not self.options.resume:
                    p.open[s.id] = {**item, "attempt": 1, "last_status": None}
                elif self._is_done(item, s):
                    del p.open[s.id]
                    if item["last_slices_hash"] == predicate_hash(p.slices):
                        p.covered[s.id] = (item["last_rows_first"], item["last_rows_several"])
                else:
                    p.open[s.id] = item

    @staticmethod
    def _is_done(item: dict, part: Slice) -> bool:
        """Committed, and with the predicate the slice has now."""
        known = item["last_predicate_hash"]
        return item["last_status"] == COMMITTED and known in (None, predicate_hash([part]))

    def run(self, planned: _Planned) -> list[tuple]:
        task = planned.task
        if planned.error:
            return [_failure(task, None, planned.error)]
        if self.options.consistency == "high_watermark":
            return self._increment(planned)
        todo = [s for s in planned.slices if s.id in planned.open]
        planned.whole = self._whole(planned)
        width = self.options.slices_per_pass
        passes = [todo[i : i + width] for i in range(0, len(todo), width)]
        with ThreadPoolExecutor(max_workers=self.options.slice_concurrency) as pool:
            done = pool.map(lambda part: self._run_pass(planned, part), passes)
            rows = [row for part_rows in done for row in part_rows]
        if self.slicer:
            rows += self._uncovered(planned, rows)
        rows += [
            (task.task_id, s.id, task.target_prefix, SKIPPED, 0, 0, 0, None)
            for s in planned.slices
            if s.id not in planned.open
        ]
        return rows

    def _increment(self, planned: _Planned) -> list[tuple]:
        task = planned.task
        slicer = None if self.slicer is None else lambda fresh: self.slicer(task, fresh)
        try:
            done = export_new_slices(
                planned.frame, self.options.watermark_column, single_target(task.target_prefix),
                self.options, self.manifest, f"{self.job_id}/{task.task_id}", slicer,
            )
        except Exception as error:
            return [_failure(task, None, error)]
        if not done:
            return [(task.task_id, "single", task.target_prefix, SKIPPED, 0, 0, 0, None)]
        return [(task.task_id, o.slice_id, o.target, COMPLETED, o.rows, o.bytes, o.files, None) for o in done]

    def _uncovered(self, planned: _Planned, rows: list[tuple]) -> list[tuple]:
        """A failed row if the slices leave rows out or keep some twice.

        Rows were counted as they were written, in this run or in earlier ones, whose
        counts the manifest has. Only where it has them for other slices, or the source
        reads slices itself, are the predicates counted again.
        """
        if any(row[3] != COMPLETED for row in rows):
            return []
        facts = [planned.covered.get(s.id) for s in planned.slices]
        if all(fact and None not in fact for fact in facts):
            total = planned.frame.count() if planned.total is None else planned.total
            none, several = total - sum(f[0] for f in facts), sum(f[1] for f in facts)
        else:
            none, several = uncovered_rows(planned.frame, planned.slices)
        if not (none or several):
            return []
        text = f"{none} rows are in no slice, {several} in several"
        if self.options.allow_uncovered:
            log.warning("%s: %s", planned.task.task_id, text)
            return []
        return [_failure(planned.task, None, ValueError(text))]

    def _whole(self, planned: _Planned) -> list[Slice] | None:
        """All slices, if the source leaves their predicates to Spark and all make sense."""
        if not self.slicer or (planned.task.kind == TABLE and hasattr(self.source, "sliced")):
            return None
        try:
            for s in planned.slices:
                planned.frame.where(s.predicate or "true")
        except Exception:
            return None
        return planned.slices

    def _sound(self, planned: _Planned, part: list[Slice]) -> tuple[list[Slice], list[tuple]]:
        """The slices whose predicates can be analysed, and result rows of the others."""
        sound, bad = [], []
        for s in part:
            try:
                if s.predicate is not None and hasattr(self.source, "root"):
                    planned.frame.where(s.predicate)
                sound.append(s)
            except Exception as error:
                item = planned.open[s.id]
                if self.manifest:
                    self.manifest.start([item])
                    self.manifest.append([self.manifest.failed(item, _message(error))])
                bad.append(_failure(planned.task, s.id, error))
        return sound, bad

    def _run_pass(self, planned: _Planned, part: list[Slice]) -> list[tuple]:
        task, manifest = planned.task, self.manifest
        self.source.spark.sparkContext.setLocalProperty("spark.scheduler.pool", task.task_id)
        part, bad = self._sound(planned, part)
        if not part:
            return bad
        items = [planned.open[s.id] for s in part]
        try:
            if manifest:
                manifest.start(items)
            done = self._write(planned, part)
            for out in done:
                planned.covered[out.slice_id] = (out.rows_first, out.rows_several)
                planned.total = out.rows_of_source if planned.total is None else planned.total
            if manifest:
                hashes = {s.id: predicate_hash([s]) for s in part}
                records = [
                    manifest.finish(
                        planned.open[out.slice_id],
                        object_path=out.target,
                        row_count=out.rows,
                        bytes_compressed=out.bytes,
                        bytes_uncompressed=out.bytes if self.options.compression == "none" else None,
                        predicate_hash=hashes[out.slice_id],
                        slices_hash=predicate_hash(planned.slices),
                        rows_first=out.rows_first,
                        rows_several=out.rows_several,
                        row_digest=out.digest,
                    )
                    for out in done
                ]
                manifest.append([row for pair in records for row in pair])
            return bad + [
                (task.task_id, o.slice_id, o.target, COMPLETED, o.rows, o.bytes, o.files, None)
                for o in done
            ]
        except Exception as error:
            if manifest:
                manifest.append([manifest.failed(item, _message(error)) for item in items])
            if len(part) == 1:
                return [*bad, _failure(task, part[0].id, error)]
            # Which slice is at fault shows when each runs alone, as a next attempt.
            for s in part:
                if planned.open[s.id]:
                    again = {"attempt": planned.open[s.id]["attempt"] + 1, "last_status": "failed"}
                    planned.open[s.id] = {**planned.open[s.id], **again}
            return bad + [row for s in part for row in self._run_pass(planned, [s])]

    def _write(self, planned: _Planned, part: list[Slice]) -> list[Published]:
        task, options = planned.task, self.options
        if len(part) == 1 and part[0].predicate is None:
            target = single_target(task.target_prefix, part[0].id)
            out = export_frame(planned.frame, target, options, planned.table)
            return [replace(out, slice_id=part[0].id)]
        numbered = None
        if task.kind == TABLE and hasattr(self.source, "sliced"):
            rows = self.source.sliced(task.table_schema, task.table_name, part)
            if task.predicate is not None:
                rows = rows.where(task.predicate)
            numbered = rows.withColumn(SLICE_COLUMN, F.spark_partition_id())
        try:
            return export_slices(
                planned.frame, part, task.target_prefix, options, planned.table, numbered, planned.whole
            )
        except Exception:
            if planned.whole is None or len(part) > 1:
                raise
            # The predicate at fault may be another slice's.
            return export_slices(planned.frame, part, task.target_prefix, options, planned.table, numbered)


def verify_job(spark: SparkSession, manifest: Manifest, schemas: dict[str, T.StructType], fmt: str) -> DataFrame:
    """Whether each committed unit of a job can be read back as it was exported.

    One row (object_path, row_count, verified, error) for each; ``schemas`` has the schema
    of each table or query by its name. Units exported without a digest are not verified.
    """
    done = latest(manifest.records()).where(F.col("status") == COMMITTED).collect()

    def check(unit: Row) -> tuple:
        error = None
        if unit.row_digest:
            try:
                verify_export(spark, unit.object_path, fmt, schemas[unit.table or unit.query_name], unit.row_digest)
            except Exception as found:
                error = _message(found)
        return unit.object_path, unit.row_count, bool(unit.row_digest) and error is None, error

    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(check, done))
    return small_frame(spark, rows, "object_path string, row_count long, verified boolean, error string")


def _task_frames(
    source, task: Row, options: ExportOptions, job_id: str
) -> tuple[DataFrame | None, DataFrame]:
    """(plain scan, rows to export) of a task; a query has no plain scan."""
    pinned = options.consistency == "database_snapshot" and not hasattr(source, "sliced")
    if pinned and (task.kind != TABLE or not options.manifest_dir):
        raise ValueError("database_snapshot pins the files of tables, and needs a manifest_dir")
    if task.kind != TABLE:
        return None, source.query(task.sql)
    table = source.frame(task.table_schema, task.table_name)
    if pinned:
        table = _pinned(source.spark, table, task, options, job_id)
    return table, table if task.predicate is None else table.where(task.predicate)


def _pinned(
    spark: SparkSession, frame: DataFrame, task: Row, options: ExportOptions, job_id: str
) -> DataFrame:
    """The table as the job's first run saw it, for every later run of the job."""
    name = task.task_id.replace(":", "_").replace("/", "_")
    pins = f"{options.manifest_dir.rstrip('/')}-pins/{job_id}/{name}"
    if not Store(spark, pins).files(pins):
        pin_files(frame, pins)
    return read_pinned(spark, pins, frame.schema)


def _slice_key(task: Row, part: Slice, job_id: str) -> dict:
    return {
        "job_id": job_id,
        "database": task.table_catalog,
        "schema": task.table_schema,
        "table": task.table_name,
        "query_name": task.query_name,
        "partition_id": part.id,
        "file_index": 0,
    }


def _identity(key: dict) -> tuple:
    return tuple(key.get(name) for name in KEY_FIELDS)


def _failure(task: Row, slice_id: str | None, error: Exception) -> tuple:
    return (task.task_id, slice_id, task.target_prefix, FAILED, 0, 0, 0, _message(error))


def _message(error: Exception) -> str:
    return str(error).strip().split("\n")[0] or type(error).__name__
