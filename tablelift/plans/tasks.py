"""Task lists: what a job will export, as a DataFrame with one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablelift.functions.names import fill_template, path_safe, table_path, table_target
from tablelift.options import ExportOptions
from tablelift.session import small_frame
from tablelift.sources.catalog import base_tables, match_tables, require_tables

TABLE, QUERY = "table", "query"


def table_tasks(
    tables: DataFrame, options: ExportOptions, predicate: str | None = None
) -> DataFrame:
    """One task per row of a tables frame (``table_catalog, table_schema, table_name``)."""
    database, schema, table = (
        F.col(c) for c in ("table_catalog", "table_schema", "table_name")
    )
    sql = F.concat(F.lit("select * from "), F.concat_ws(".", *map(_quoted, (database, schema, table))))
    if predicate is not None:
        sql = F.concat(sql, F.lit(f" where {predicate}"))
    return tables.select(
        F.concat(F.lit("table:"), table_path(database, schema, table)).alias("task_id"),
        F.lit(TABLE).alias("kind"),
        database.alias("table_catalog"),
        schema.alias("table_schema"),
        table.alias("table_name"),
        F.lit(None).cast("string").alias("query_name"),
        F.lit(predicate).cast("string").alias("predicate"),
        sql.alias("sql"),
        table_target(options.target, database, schema, table).alias("target_prefix"),
        F.lit(None).cast("string").alias("partition_hint"),
    )


def one_table_tasks(
    source, schema: str, table: str, options: ExportOptions, predicate: str | None = None
) -> DataFrame:
    options.checked()
    chosen = base_tables(source.tables(), schema).where(F.col("table_name") == table)
    return table_tasks(require_tables(chosen, f"{schema}.{table}"), options, predicate)


def query_tasks(
    source, name: str, sql: str, options: ExportOptions, partition_template: str | None = None
) -> DataFrame:
    """One task for a query whose text is passed on as it is."""
    options.checked()
    if not name.strip() or not sql.strip():
        raise ValueError("a query needs both a name and a text")
    rows = [(QUERY, None, None, None, name, None, sql, partition_template)]
    schema = (
        "kind string, table_catalog string, table_schema string, table_name string, "
        "query_name string, predicate string, sql string, partition_hint string"
    )
    return small_frame(source.spark, rows, schema).select(
        F.concat(F.lit("query:"), path_safe(F.col("query_name"))).alias("task_id"),
        "kind",
        "table_catalog",
        "table_schema",
        "table_name",
        "query_name",
        "predicate",
        "sql",
        fill_template(options.target, query=F.col("query_name")).alias("target_prefix"),
        "partition_hint",
    )


def schema_tasks(
    source,
    schema: str,
    options: ExportOptions,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
) -> DataFrame:
    options.checked()
    if not schema.strip():
        raise ValueError("a schema export needs a schema")
    tables = match_tables(base_tables(source.tables(), schema), include or [], exclude or [])
    return distinct_targets(table_tasks(require_tables(tables, schema), options))


def database_tasks(
    source,
    options: ExportOptions,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
) -> DataFrame:
    options.checked()
    tables = match_tables(base_tables(source.tables()), include or [], exclude or [])
    return distinct_targets(table_tasks(require_tables(tables, "database"), options))


def distinct_targets(tasks: DataFrame) -> DataFrame:
    """The tasks, refused if two of them would write to one place."""
    clash = tasks.groupBy("target_prefix").count().where("count > 1").first()
    if clash:
        raise ValueError(f"{clash['count']} tasks share the target {clash['target_prefix']}")
    return tasks


def dry_run(tasks: DataFrame) -> DataFrame:
    """Summary of a job that only plans: the number of tasks, and nothing done."""
    return tasks.agg(
        F.count(F.lit(1)).alias("planned_tasks"),
        F.lit(0).cast("long").alias("completed_tasks"),
        F.lit(0).cast("long").alias("skipped_tasks"),
        F.lit(0).cast("long").alias("bytes_written"),
    )


def _quoted(name: Column) -> Column:
    return F.when(
        name.isNotNull(),
        F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`")),
    )
