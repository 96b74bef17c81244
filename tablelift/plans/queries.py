"""Named queries over a folder of tables. Each runs a real job over whole tables and
returns what came out of it, read back from the exported files."""

from __future__ import annotations

import datetime as dt
import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablelift.datagen import tables as datagen
from tablelift.datagen.report import profile, row_counts
from tablelift.functions.types import (
    as_text,
    cast_loss,
    conform,
    conform_strict,
    nullable_schema,
    schema_from_columns,
)
from tablelift.operators.incremental import export_new_rows, late_rows
from tablelift.operators.layout import SIZE_TOLERANCE
from tablelift.operators.manifest import (
    COMMITTED,
    FAILED,
    PLANNED,
    RUNNING,
    UPLOADED,
    Manifest,
    illegal_moves,
    latest,
    lookup,
    next_attempts,
    stable_id,
)
from tablelift.operators.sinks import export_frame
from tablelift.operators.slices import (
    Slice,
    predicate_slices,
    range_slices,
    slice_report,
    template_slices,
)
from tablelift.options import DEFAULT_FILE_BYTES, ExportOptions
from tablelift.plans.config import run as run_config
from tablelift.plans.job import raise_on_failure, run_job, summary
from tablelift.plans.tasks import (
    database_tasks,
    dry_run,
    one_table_tasks,
    query_tasks,
    schema_tasks,
)
from tablelift.session import fresh_dir, small_frame
from tablelift.sources.catalog import COLUMNS_SCHEMA, LakeSource, base_tables, match_tables
from tablelift.sources.readback import read_export
from tablelift.sources.tables import pin_files, read_pinned, scan
from tablelift.storage import Store, file_stats
from tablelift.streaming.incremental import export_new_files

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def lake(spark: SparkSession, sf_dir: str) -> LakeSource:
    return LakeSource(spark, sf_dir, names=TABLE_NAMES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return lake(spark, sf_dir).frame("dbo", name)


def exported(df: DataFrame, table: DataFrame | None = None, **options) -> DataFrame:
    """Export a frame to a new folder and read it back."""
    target = fresh_dir(df.sparkSession, "export")
    wanted = ExportOptions(target=target, **options)
    export_frame(df, target, wanted, table)
    return read_export(df.sparkSession, target, wanted.format, df.schema)


def exported_table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    whole = table(spark, sf_dir, name)
    return exported(whole, whole, **options)


# Scans


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "lineitem")


def table_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    options = ExportOptions(target=fresh_dir(spark, "where") + "/{schema}/{table}")
    tasks = one_table_tasks(source, "dbo", "orders", options, "o_totalprice > 1000")
    results = raise_on_failure(run_job(source, tasks, options))
    target = results.first().target
    return read_export(spark, target, "parquet", source.frame("dbo", "orders").schema)


def column_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_mktsegment", "c_custkey", "c_name"]
    customers = table(spark, sf_dir, "customer")
    return exported(scan(customers, columns, "c_acctbal > 0"), scan(customers, columns))


def exported_query(name: str, sql: str):
    """A query export as a registered query."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = lake(spark, sf_dir)
        options = ExportOptions(target=fresh_dir(spark, "query") + "/{query}")
        tasks = query_tasks(source, name, sql, options)
        target = raise_on_failure(run_job(source, tasks, options)).first().target
        return read_export(spark, target, "parquet", source.query(sql).schema)

    return run


# Catalog and fan-out


def _counts(source: LakeSource, tables: DataFrame) -> DataFrame:
    chosen = [(r.table_schema, r.table_name) for r in tables.collect()]
    counts = [
        source.frame(schema, name).agg(
            F.lit(schema).alias("table_schema"),
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for schema, name in chosen
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    return _counts(source, base_tables(source.tables(), "DBO"))


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table's columns in order, with how many values each holds."""
    source = lake(spark, sf_dir)
    parts = []
    for name in TABLE_NAMES:
        frame = source.frame("dbo", name)
        values = cast_loss(frame, frame.schema).select("column_name", "values_before")
        columns = source.columns("dbo", name).select(
            "table_name", "ordinal_position", "column_name", "is_nullable", "data_type"
        )
        parts.append(columns.join(values, "column_name"))
    return reduce(DataFrame.unionByName, parts)


def glob_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    chosen = match_tables(
        base_tables(source.tables()), ["*.[c-o]*", "dbo.{part,pages}"], ["*.*s", "*.nation"]
    )
    return _counts(source, chosen)


def _fan_out(source: LakeSource, tasks: DataFrame, options: ExportOptions) -> DataFrame:
    """Rows reported and rows found in the files, per exported table."""
    results = raise_on_failure(run_job(source, tasks, options))
    found = []
    for row in results.collect():
        name = row.task_id.rsplit("/", 1)[-1]
        schema = source.frame("dbo", name).schema
        back = read_export(source.spark, row.target, options.format, schema)
        found.append(
            back.agg(
                F.lit(row.task_id).alias("task_id"),
                F.lit(row.rows).cast("long").alias("rows_reported"),
                F.count(F.lit(1)).alias("rows_found"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def schema_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    options = ExportOptions(target=fresh_dir(spark, "schema") + "/{database}/{schema}/{table}")
    return _fan_out(source, schema_tasks(source, "dbo", options), options)


def database_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    options = ExportOptions(
        target=fresh_dir(spark, "database") + "/{schema}/{table}", format="json", compression="gzip"
    )
    tasks = database_tasks(source, options, exclude=["*.embed*", "*.l*"])
    return _fan_out(source, tasks, options)


# Slices


def _sliced_orders(
    spark: SparkSession, sf_dir: str, key: str, slices: list[Slice], per_pass: int = 32
) -> DataFrame:
    """Export orders in slices; rows and key bounds of each slice as found in its files."""
    source = lake(spark, sf_dir)
    options = ExportOptions(
        target=fresh_dir(spark, "slices") + "/{table}/{partition}", slices_per_pass=per_pass,
        allow_uncovered=True,
    )
    tasks = one_table_tasks(source, "dbo", "orders", options)
    results = raise_on_failure(run_job(source, tasks, options, lambda task, frame: slices))
    schema = source.frame("dbo", "orders").schema
    parts = [
        read_export(spark, row.target, "parquet", schema).agg(
            F.lit(row.slice_id).alias("slice_id"),
            F.count(F.lit(1)).alias("row_count"),
            F.min(key).alias("min_key"),
            F.max(key).alias("max_key"),
        )
        for row in results.collect()
    ]
    return reduce(DataFrame.unionByName, parts)


def slice_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = predicate_slices(
        [
            "o_totalprice < 50000",
            "o_totalprice >= 50000 AND o_totalprice < 200000",
            "o_totalprice >= 200000",
        ]
    )
    return _sliced_orders(spark, sf_dir, "o_totalprice", slices)


def slice_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = dt.datetime(1992, 1, 1), dt.datetime(2000, 1, 1)
    slices = range_slices(
        "o_orderdate", T.TimestampNTZType(), start, end, 4, "dbo/orders", nulls=True
    )
    return _sliced_orders(spark, sf_dir, "o_orderdate", slices, per_pass=1)


def slice_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    slices = template_slices(orders, "o_orderkey", "o_orderkey BETWEEN {lo} AND {hi}", 4)
    return _sliced_orders(spark, sf_dir, "o_orderkey", slices)


def slice_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    slices = template_slices(lines, "l_shipdate", "l_shipdate BETWEEN {start} AND {end}", 8)
    return slice_report(lines, slices, "l_shipdate").groupBy("slices_hit").agg(
        F.sum("row_count").alias("row_count")
    )


# Types

LINEITEM_DECLARED = [
    ("l_orderkey", "INT", "NO", None, None),
    ("l_partkey", "bigint", "YES", None, None),
    ("l_suppkey", "int", "YES", None, None),
    ("l_linenumber", "tinyint", "NO", None, None),
    ("l_quantity", "decimal", "YES", 15, 2),
    ("l_extendedprice", "money", "YES", 19, 4),
    ("l_discount", "real", "YES", None, None),
    ("l_tax", "float", "YES", None, None),
    ("l_returnflag", "char", "YES", None, None),
    ("l_linestatus", "nvarchar", "YES", None, None),
    ("l_shipdate", "datetime2", "YES", None, None),
]
ORDERS_DECLARED = T.StructType(
    [
        T.StructField("o_orderkey", T.IntegerType()),
        T.StructField("o_custkey", T.ShortType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(7, 2)),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_orderpriority", T.IntegerType()),
    ]
)


def _numbers_as_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.NumericType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def schema_from_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rows = [
        ("dbo", "lineitem", i, name, kind, nullable, precision, scale)
        for i, (name, kind, nullable, precision, scale) in enumerate(LINEITEM_DECLARED, start=1)
    ]
    schema = schema_from_columns(small_frame(spark, rows, COLUMNS_SCHEMA))
    return _numbers_as_double(exported(conform(lines, schema)))


def catalog_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table conformed to the schema that its own catalog rows give."""
    source = lake(spark, sf_dir)
    schema = schema_from_columns(source.columns("dbo", "orders"))
    return exported(conform(source.frame("dbo", "orders"), schema))


def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _numbers_as_double(exported(conform(orders, ORDERS_DECLARED)))


def column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    reordered = T.StructType(list(reversed(nullable_schema(part.schema).fields)))
    return exported(conform_strict(part, reordered))


def text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_acctbal") > 0).alias("in_credit"), "c_name"
    )
    return exported(as_text(customers), format="csv", compression="none")


def cast_loss_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_loss(table(spark, sf_dir, "orders"), ORDERS_DECLARED)


# Formats and file layout


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "documents", format="csv", compression="none")


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "pages", format="tsv", compression="none")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "conversations", format="json", compression="none")


def gzip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snappy is not offered with text, so this comes out as gzip."""
    return exported_table(spark, sf_dir, "events", format="csv", compression="snappy")


def zstd_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "documents", format="csv", compression="zstd")


def zstd_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "lineitem", format="json", compression="zstd")


def zstd_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported_table(spark, sf_dir, "orders", compression="zstd")


def nested_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array column and a binary one through a flat text format."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "raw", F.col("label").cast("string").cast("binary")
    )
    back = exported(vectors, format="csv", compression="gzip")
    return back.select(
        "vec_id",
        "label",
        F.size("embedding").alias("dimensions"),
        F.col("embedding")[0].cast("double").alias("first_value"),
        F.col("raw").cast("string").alias("raw_text"),
    )


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    cap = min(1_000_000, math.ceil(lines.count() / 8) or 1)
    target = fresh_dir(spark, "rows")
    options = ExportOptions(target=target, max_rows_per_file=cap)
    export_frame(lines, target, options, lines)
    per_file = (
        read_export(spark, target, "parquet", lines.schema)
        .groupBy(F.col("_metadata.file_name").alias("file_name"))
        .count()
    )
    return per_file.agg(
        F.sum("count").alias("row_count"),
        F.count_if(F.col("count") > cap).alias("files_over_limit"),
        F.count_if(~F.col("file_name").rlike(r"^part-\d{5}\.parquet$")).alias("odd_names"),
    )


def split_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    size, _ = Store(spark, sf_dir).usage(f"{sf_dir}/documents.parquet")
    goal = max(1, min(DEFAULT_FILE_BYTES, size // 6))
    target = fresh_dir(spark, "size")
    options = ExportOptions(target=target, target_file_bytes=goal)
    out = export_frame(documents, target, options, documents)
    return file_stats(spark, target).agg(
        (F.max("bytes") <= SIZE_TOLERANCE * goal).alias("sizes_hold"),
        (F.count(F.lit(1)) > 1).alias("was_split"),
        F.lit(out.rows).cast("long").alias("row_count"),
    )


def empty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity < 0")
    target = fresh_dir(spark, "empty")
    out = export_frame(lines, target, ExportOptions(target=target))
    return file_stats(spark, target).agg(
        F.count(F.lit(1)).alias("file_count"), F.lit(out.rows).cast("long").alias("row_count")
    )


def overwrite_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second export takes the whole place of a first one that had more files."""
    orders = table(spark, sf_dir, "orders")
    target = fresh_dir(spark, "overwrite")
    many = ExportOptions(target=target, max_rows_per_file=max(1, orders.count() // 5))
    export_frame(orders, target, many, orders)
    out = export_frame(orders.where("o_orderstatus = 'F'"), target, ExportOptions(target=target))
    back = read_export(spark, target, "parquet", orders.schema)
    found = file_stats(spark, target).agg(F.count(F.lit(1)), F.sum("bytes")).first()
    return back.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max("o_orderstatus").alias("highest_status"),
        F.lit(found[0] == out.files).alias("files_match"),
        F.lit(found[1] == out.bytes).alias("bytes_match"),
    )


def append_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = fresh_dir(spark, "append")
    options = ExportOptions(target=target, mode="append", format="json", compression="gzip")
    for predicate in ("o_totalprice < 100000", "o_totalprice >= 100000"):
        export_frame(orders.where(predicate), target, options)
    return read_export(spark, target, "json", orders.schema)


# Plans, results, state


def dry_run_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task list, and the rows each task would read."""
    source = lake(spark, sf_dir)
    options = ExportOptions(target="/lake/{database}/{schema}/{table}/part-{file_index}")
    tasks = schema_tasks(source, "dbo", options, exclude=["*.embeddings"])
    counts = _counts(source, tasks.select("table_schema", "table_name"))
    return tasks.join(counts, ["table_schema", "table_name"]).select(
        "task_id", "kind", "sql", "target_prefix", F.col("row_count").alias("source_rows")
    )


def dry_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lake(spark, sf_dir)
    tasks = database_tasks(source, ExportOptions(target="/lake/{schema}/{table}"))
    counts = _counts(source, tasks.select("table_schema", "table_name"))
    rows = counts.agg(F.sum("row_count")).first()[0]
    return dry_run(tasks).withColumn("source_rows", F.lit(rows).cast("long"))


def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a job in which one task cannot work and the others go on."""
    source = lake(spark, sf_dir)
    options = ExportOptions(target=fresh_dir(spark, "summary") + "/{schema}/{table}")
    good = schema_tasks(source, "dbo", options, include=["*.orders", "*.customer", "*.part"])
    bad = one_table_tasks(source, "dbo", "lineitem", options, "no_such_column = 1")
    totals = summary(run_job(source, good.unionByName(bad), options))
    return totals.select(
        "completed_tasks",
        "failed_tasks",
        "skipped_tasks",
        "rows_exported",
        (F.col("bytes_written") > 0).alias("has_bytes"),
        F.size("errors").cast("long").alias("error_count"),
        F.get("errors", F.lit(0)).startswith("table:dbo/lineitem: ").alias("names_task"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest records made from the orders table: a customer is a unit of work, its
    orders in key order are what happened to it."""
    states = F.create_map(
        *[
            F.lit(v)
            for pair in zip(
                ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
                (PLANNED, RUNNING, UPLOADED, COMMITTED, FAILED),
            )
            for v in pair
        ]
    )
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.lit("job").alias("job_id"),
            F.lit(None).cast("string").alias("database"),
            F.lit("dbo").alias("schema"),
            F.lit("orders").alias("table"),
            F.lit(None).cast("string").alias("query_name"),
            F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("partition_id"),
            F.lit(0).cast("long").alias("file_index"),
            states[F.col("o_orderpriority")].alias("status"),
            F.col("o_orderstatus").alias("error"),
            F.round(F.col("o_totalprice") * 100).cast("long").alias("row_count"),
            F.year("o_orderdate").alias("attempt"),
            F.col("o_orderkey").alias("seq"),
        )
        .withColumn("stable_id", stable_id())
    )


def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(order_log(spark, sf_dir)).select(
        "stable_id", "partition_id", "status", "row_count", "seq"
    )


def manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of the customers of one market segment."""
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    keys = wanted.select(
        F.lit("job").alias("job_id"),
        F.lit(None).cast("string").alias("database"),
        F.lit("dbo").alias("schema"),
        F.lit("orders").alias("table"),
        F.lit(None).cast("string").alias("query_name"),
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("partition_id"),
        F.lit(0).cast("long").alias("file_index"),
    ).withColumn("stable_id", stable_id())
    found = lookup(order_log(spark, sf_dir), keys)
    return found.select("partition_id", "status", "seq")


def manifest_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        illegal_moves(order_log(spark, sf_dir))
        .groupBy("previous_status", "status")
        .agg(F.count(F.lit(1)).alias("move_count"), F.max("seq").alias("last_seq"))
    )


def manifest_open_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers whose work is not committed, with the number of the next attempt."""
    todo = table(spark, sf_dir, "customer").select(
        F.lit("job").alias("job_id"),
        F.lit(None).cast("string").alias("database"),
        F.lit("dbo").alias("schema"),
        F.lit("orders").alias("table"),
        F.lit(None).cast("string").alias("query_name"),
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("partition_id"),
        F.lit(0).cast("long").alias("file_index"),
    ).withColumn("stable_id", stable_id())
    work = next_attempts(todo, order_log(spark, sf_dir))
    return work.select("partition_id", "attempt", "last_status", "last_error")


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.select(
        F.lit("job").alias("job_id"),
        F.lit(None).cast("string").alias("database"),
        F.lit("dbo").alias("schema"),
        F.lit("lineitem").alias("table"),
        F.lit(None).cast("string").alias("query_name"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("partition_id"),
        F.col("l_orderkey").alias("file_index"),
    )
    return keys.select(F.col("file_index").alias("l_orderkey"), stable_id().alias("stable_id"))


def _resumed_orders(spark: SparkSession, sf_dir: str) -> tuple[str, Manifest]:
    """A job of three slices, the second of which fails at first, then its resumption."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "resume")
    options = ExportOptions(
        target=home + "/{table}/{partition}",
        manifest_dir=home + "-manifest",
        resume=True,
        slices_per_pass=1,
        consistency="database_snapshot",
    )
    predicates = ["o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'P'"]
    broken = [predicates[0], "no_such_column = 'O'", predicates[2]]
    tasks = one_table_tasks(source, "dbo", "orders", options)
    run_job(source, tasks, options, lambda task, frame: predicate_slices(broken), "orders-job")
    again = run_job(
        source, tasks, options, lambda task, frame: predicate_slices(predicates), "orders-job"
    )
    raise_on_failure(again)
    return home + "/orders", Manifest(spark, options.manifest_dir)


def resume_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _resumed_orders(spark, sf_dir)
    return read_export(spark, target, "parquet", table(spark, sf_dir, "orders").schema)


def resume_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, manifest = _resumed_orders(spark, sf_dir)
    illegal = illegal_moves(manifest.records()).count()
    last = latest(manifest.records()).select("partition_id", "status", "attempt", "row_count")
    return last.withColumn("illegal_moves", F.lit(illegal).cast("long"))


# Consistency and increments


def pinned_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pinned, while the same rows arrive in the folder once more."""
    orders = table(spark, sf_dir, "orders")
    folder = fresh_dir(spark, "landing")
    orders.write.parquet(folder)
    before = spark.read.parquet(folder)
    pins = fresh_dir(spark, "pins")
    pin_files(before, pins)
    orders.write.mode("append").parquet(folder)
    return exported(read_pinned(spark, pins, before.schema))


def incremental_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events exported in three runs: part of the time, all of it, nothing new."""
    events = table(spark, sf_dir, "events")
    target = fresh_dir(spark, "increments")
    manifest = Manifest(spark, target + "-manifest")
    options = ExportOptions(target=target, consistency="high_watermark")
    seen = events.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    for state in (seen, events, events):
        export_new_rows(state, "ts", target, options, manifest, "events")
    back = read_export(spark, target, "parquet", events.schema)
    increment = F.regexp_extract(F.col("_metadata.file_path"), r"increment-(\d+)", 1)
    return back.groupBy(increment.cast("int").alias("increment")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land in two arrivals, exported as a stream after each."""
    events = table(spark, sf_dir, "events")
    landing, target = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    state = fresh_dir(spark, "stream-state")
    options = ExportOptions(target=target)
    for arrival in ("ts < TIMESTAMP_NTZ '2024-01-10 00:00:00'", "ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'"):
        events.where(arrival).write.mode("append").parquet(landing)
        export_new_files(spark, landing, events.schema, target, options, state)
    back = read_export(spark, target, "parquet", events.schema)
    return back.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("event_count")
    )


def late_row_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases that were not there when events were exported up to a moment."""
    events = table(spark, sf_dir, "events")
    mark = "2024-01-20 00:00:00"
    early = events.where(f"event_type <> 'purchase' AND ts <= TIMESTAMP_NTZ '{mark}'")
    done = exported(early)
    return late_rows(events, done, ["event_id"], "ts", mark)


# Generated tables, one row for each row of a given table


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Row ids from 1, from a unique key of a table given as SQL."""
    return table(spark, sf_dir, name).select((F.expr(key).cast("long") + 1).alias("id"))


def _profiled(source: str, key: str, name: str, column: str, shares: dict, ranges: dict):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = datagen.GENERATORS[name](_ids(spark, sf_dir, source, key))
        return profile(exported(made), column, shares, ranges)

    return run


# Order and line number repeat in the given table, so a line's key is a hash of its columns.
LINE_KEY = (
    "xxhash64(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,"
    " l_discount, l_tax, l_shipdate) & 9007199254740991"
)

GENERATED = {
    "gen_customers": _profiled(
        "orders", "o_orderkey", "dbo.customers", "customer_id",
        {"gender": 80, "last_login": 80, "notes": 20, "address_line2": 0},
        {"credit_limit": (500, 50_000), "loyalty_points": (0, 200_000),
         "account_balance": (-1_000, 50_000)},
    ),
    "gen_products": _profiled(
        "orders", "o_orderkey", "dbo.products", "sku",
        {"sub_category": 80, "rating": 80, "image_url": 0},
        {"unit_price": (1, 1_000), "stock_qty": (0, 10_000), "reorder_level": (5, 100),
         "review_count": (0, 5_000)},
    ),
    "gen_orders": _profiled(
        "orders", "o_orderkey", "dbo.orders", "order_number",
        {"shipped_date": 70, "tracking_number": 70, "notes": 10},
        {"customer_id": (1, 500_000), "total_amount": (10, 5_000), "shipping_cost": (0, 100)},
    ),
    "gen_order_items": _profiled(
        "lineitem", LINE_KEY, "dbo.order_items", "item_id",
        {"warehouse_code": 100, "notes": 0},
        {"order_id": (1, 2_000_000), "product_id": (1, 100_000), "quantity": (1, 20),
         "discount_pct": (0, 30)},
    ),
    "gen_events": _profiled(
        "events", "event_id", "dbo.events", "event_uuid",
        {"duration_ms": 80, "user_id": 90, "user_agent": 60, "error_code": 20,
         "error_message": 20, "processed_at": 80},
        {"severity": (0, 4), "event_id": (1, 2**62)},
    ),
    "gen_measurements": _profiled(
        "lineitem", LINE_KEY, "dbo.measurements", "checksum",
        {"temperature_c": 100},
        {"temperature_c": (-40.0, 85.0), "pressure_hpa": (800.0, 1_200.0),
         "latitude": (-90, 90), "longitude": (-180, 180), "signal_strength": (-120, 0),
         "battery_pct": (0, 100)},
    ),
    "gen_transactions": _profiled(
        "orders", "o_orderkey", "sales.transactions", "trans_uuid",
        {"reference_num": 30},
        {"amount": (0, 10_000), "exchange_rate": (0, 1)},
    ),
    "gen_employees": _profiled(
        "orders", "o_orderkey", "hr.employees", "email",
        {"middle_name": 40, "phone_mobile": 80, "termination_dt": 5, "bio": 25},
        {"job_level": (1, 8), "salary": (30_000, 250_000), "bonus_pct": (0, 30)},
    ),
}


def gen_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the generated tables, counted in what was exported."""
    sources = {
        "dbo.customers": ("customer", "c_custkey"),
        "dbo.products": ("part", "p_partkey"),
        "dbo.orders": ("orders", "o_orderkey"),
        "dbo.order_items": ("lineitem", LINE_KEY),
        "dbo.events": ("events", "event_id"),
        "dbo.measurements": ("documents", "doc_id"),
        "sales.transactions": ("conversations", "conv_id * 1000 + turn"),
        "hr.employees": ("supplier", "s_suppkey"),
    }
    return row_counts(
        {
            name: exported(datagen.GENERATORS[name](_ids(spark, sf_dir, *source)))
            for name, source in sources.items()
        }
    )


# Jobs and targets


def job_row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row limit in jobs: given alone, and with a size in a configuration."""
    source = lake(spark, sf_dir)
    lines = source.frame("dbo", "lineitem")
    cap = max(1, lines.count() // 80)
    home = fresh_dir(spark, "limit")
    options = ExportOptions(target=home + "/job/{table}", max_rows_per_file=cap)
    raise_on_failure(run_job(source, one_table_tasks(source, "dbo", "lineitem", options), options))
    config = {
        "target": home + "/config/{table}", "target_file_size": DEFAULT_FILE_BYTES,
        "max_rows_per_file": cap, "scope": {"type": "table", "table": {"table": "lineitem"}},
    }
    raise_on_failure(run_config(source, config))
    parts = []
    for name in ("job", "config"):
        back = read_export(spark, f"{home}/{name}/lineitem", "parquet", lines.schema)
        files = back.groupBy(F.col("_metadata.file_name").alias("file")).count()
        parts.append(files.agg(
            F.lit(name).alias("run"), F.sum("count").alias("row_count"),
            (F.count(F.lit(1)) > 64).alias("many_files"), F.count_if(F.col("count") > cap).alias("over_limit"),
        ))
    return reduce(DataFrame.unionByName, parts)


def append_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append without rows leaves what was exported before."""
    orders = table(spark, sf_dir, "orders")
    target = fresh_dir(spark, "append-empty")
    options = ExportOptions(target=target, mode="append")
    for predicate in ("o_totalprice >= 0", "o_totalprice < 0", "o_totalprice < 0"):
        export_frame(orders.where(predicate), target, options)
    return read_export(spark, target, "parquet", orders.schema)


def slice_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of a column of instants, in a session zone that is not UTC."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        events = table(spark, sf_dir, "events").select(
            "event_id", F.timestamp_micros(F.col("event_id") * 37_000_001 + 1_700_000_000_000_000).alias("at")
        )
        slices = template_slices(events, "at", "at BETWEEN {lo} AND {hi}", 6)
        report = slice_report(events, slices, "at").groupBy("slices_hit").agg(F.sum("row_count").alias("row_count"))
        return small_frame(spark, [tuple(r) for r in report.collect()], "slices_hit int, row_count long")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def slice_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that predicates leave out or keep twice are told, and fail the task."""
    source = lake(spark, sf_dir)
    options = ExportOptions(target=fresh_dir(spark, "uncovered") + "/{table}")
    slices = predicate_slices(["o_orderkey % 3 = 0", "o_orderkey % 3 = 1 OR o_orderkey % 9 = 0"])
    tasks = one_table_tasks(source, "dbo", "orders", options)
    results = run_job(source, tasks, options, lambda task, frame: slices)
    return results.select("slice_id", "status", "rows", "error")


def job_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job run twice by watermark: rows of each run, and what lies in the target."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "watermark")
    options = ExportOptions(
        target=home + "/{table}", consistency="high_watermark", watermark_column="o_orderdate",
        manifest_dir=home + "-manifest",
    )
    tasks = one_table_tasks(source, "dbo", "orders", options)
    runs = [raise_on_failure(run_job(source, tasks, options, job_id="daily")).first() for _ in range(2)]
    schema = source.frame("dbo", "orders").schema
    back = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(home + "/orders")
    return back.agg(
        F.lit(runs[0].rows).cast("long").alias("first_run"), F.lit(runs[1].rows).cast("long").alias("second_run"),
        F.count(F.lit(1)).alias("rows_found"), F.count_distinct("o_orderkey").alias("keys_found"),
    )


def resume_one_bad_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of eight slices in one pass one cannot be read; the others are exported."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "bad-slice")
    options = ExportOptions(target=home + "/{table}", manifest_dir=home + "-manifest")
    texts = [f"o_orderkey % 8 = {i}" for i in range(7)] + ["CAST(o_orderstatus AS INT) = 7"]
    tasks = one_table_tasks(source, "dbo", "orders", options)
    results = run_job(source, tasks, options, lambda t, f: predicate_slices(texts), "bad-slice")
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("slices"), F.sum("rows").alias("row_count"))


def template_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files whose folders and names a template gives."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "template")
    options = ExportOptions(target=home + "/{schema}/{table}/{partition}/chunk-{file_index}.parquet")
    tasks = schema_tasks(source, "dbo", options, include=["*.orders", "*.part"])
    raise_on_failure(run_job(source, tasks, options))
    path = F.regexp_replace(F.col("_metadata.file_path"), "^.*/dbo/", "")
    parts = [
        read_export(spark, f"{home}/dbo/{name}/single", "parquet", source.frame("dbo", name).schema)
        .groupBy(F.regexp_replace(path, r"\d{5}", "N").alias("file_pattern"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        for name in ("orders", "part")
    ]
    return reduce(DataFrame.unionByName, parts)


def config_sliced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table sliced by a range that its configuration gives."""
    source = lake(spark, sf_dir)
    home = fresh_dir(spark, "config-slices")
    config = {
        "target": home + "/{table}", "scope": {
            "type": "table", "table": {"schema": "dbo", "table": "orders"},
            "slices": {"column": "o_orderdate", "start": "1992-01-01", "end": "2100-01-01", "count": 4},
        },
    }
    results = raise_on_failure(run_config(source, config))
    back = spark.read.schema(source.frame("dbo", "orders").schema).option("recursiveFileLookup", True)
    rows = results.agg(F.sum("rows")).first()[0]
    return back.parquet(home + "/orders").agg(
        F.count_distinct("o_orderkey").alias("keys_found"), F.count(F.lit(1)).alias("rows_found"),
        F.lit(rows).cast("long").alias("rows_reported"),
    )
