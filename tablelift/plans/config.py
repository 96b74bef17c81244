"""Jobs described by one plain configuration, as it is kept in a JSON file.

    {"scope": {"type": "schema", "schema": "dbo", "include": [], "exclude": ["*.tmp_*"]},
     "target": "/out/{schema}/{table}", "format": "csv", "compression": "zstd"}
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, types as T

from tablelift.operators.slices import even_slices, predicate_slices, range_slices, template_slices
from tablelift.options import ExportOptions
from tablelift.plans.job import run_job
from tablelift.plans.tasks import database_tasks, one_table_tasks, query_tasks, schema_tasks

# Configuration names, and the option each one sets.
OPTION_NAMES = {
    "target": "target",
    "format": "format",
    "compression": "compression",
    "consistency": "consistency",
    "target_file_size": "target_file_bytes",
    "max_rows_per_file": "max_rows_per_file",
    "memory_limit_mb": "memory_limit_mb",
    "table_concurrency": "table_concurrency",
    "partition_concurrency_per_table": "slice_concurrency",
    "global_io_concurrency": "io_concurrency",
    "checkpoint_dir": "manifest_dir",
    "resume": "resume",
    "watermark_column": "watermark_column",
}


def options_of(config: dict) -> ExportOptions:
    """Options of a configuration; names that Spark has no use for are passed over."""
    given = {
        option: config[name]
        for name, option in OPTION_NAMES.items()
        if config.get(name) is not None
    }
    return ExportOptions(**{"target": "", "both_limits": True, **given}).checked()


def tasks_of(source, config: dict) -> DataFrame:
    """The task list of a configuration's scope; nothing is exported."""
    options = options_of(config)
    scope = config["scope"]
    kind = scope.get("type")
    if kind == "table":
        table = scope["table"]
        database = table.get("database")
        own = getattr(source, "database", None)
        if database is not None and own is not None and database.lower() != own.lower():
            raise LookupError(f"the source is database {own}, not {database}")
        return one_table_tasks(
            source, table.get("schema", "dbo"), table["table"], options, scope.get("predicate")
        )
    if kind == "query":
        return query_tasks(
            source, scope["name"], scope["sql"], options, scope.get("partition_template")
        )
    globs = {"include": scope.get("include", []), "exclude": scope.get("exclude", [])}
    if kind == "schema":
        return schema_tasks(source, scope["schema"], options, **globs)
    if kind == "database":
        return database_tasks(source, options, **globs)
    raise ValueError(f"unknown scope {kind!r}")


def _bound(value, kind: T.DataType):
    """A bound as JSON has it, as a value of the column."""
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(value)
    return Decimal(str(value)) if isinstance(kind, T.DecimalType) else value


def run(
    source, config: dict, job_id: str | None = None, slice_key: str | None = None
) -> DataFrame:
    """Export what a configuration asks for.

    A scope may have ``slices``: a list of predicates, or a range with ``column``,
    ``start``, ``end`` and ``count``, or with ``column``, ``count`` and ``even`` for slices
    of equal weight. With the key its partition template is about, given
    here or as ``slice_key`` of the scope, a query is sliced into as many ranges as may run
    side by side.
    """
    options = options_of(config)
    slicer = None
    slices = config["scope"].get("slices")
    slice_key = slice_key or config["scope"].get("slice_key")
    if isinstance(slices, list):

        def slicer(task, frame):
            return predicate_slices(slices)

    elif slices:

        def slicer(task, frame):
            column = slices["column"]
            if slices.get("even"):
                return even_slices(frame, column, slices["count"], task.task_id.split(":", 1)[1])
            kind = frame.schema[column].dataType
            start, end = (_bound(slices[name], kind) for name in ("start", "end"))
            return range_slices(column, kind, start, end, slices["count"], task.task_id.split(":", 1)[1])

    elif slice_key and config["scope"].get("partition_template"):

        def slicer(task, frame):
            return template_slices(
                frame, slice_key, task.partition_hint, options.slice_concurrency
            )

    return run_job(source, tasks_of(source, config), options, slicer, job_id)
