import pytest
from conftest import same_rows
from pyspark.sql import types as T

from tablelift.operators.manifest import Manifest, illegal_moves, latest
from tablelift.operators.slices import Slice, predicate_slices, range_slices, template_slices
from tablelift.options import ExportOptions
from tablelift.plans.job import raise_on_failure, run_job, summary
from tablelift.plans.tasks import database_tasks, one_table_tasks, query_tasks, schema_tasks
from tablelift.sources.jdbc import JdbcSource
from tablelift.sources.readback import read_export


def test_schema_export_writes_every_table(spark, lake, out):
    options = ExportOptions(target=out + "/{schema}/{table}")
    results = run_job(lake, schema_tasks(lake, "dbo", options), options).collect()
    assert {r.status for r in results} == {"completed"} and len(results) == 14
    for row in results:
        name = row.task_id.rsplit("/", 1)[-1]
        table = lake.frame("dbo", name)
        back = read_export(spark, row.target, "parquet", table.schema)
        assert row.rows == table.count()
        assert same_rows(back, table), name


@pytest.mark.parametrize("fmt, codec", [("csv", "gzip"), ("json", "zstd"), ("tsv", "none")])
def test_whole_texts_survive_text_formats(spark, lake, out, fmt, codec):
    options = ExportOptions(target=out + "/{table}", format=fmt, compression=codec)
    tasks = database_tasks(lake, options, include=["*.{documents,pages,conversations,events}"])
    for row in raise_on_failure(run_job(lake, tasks, options)).collect():
        table = lake.frame("dbo", row.task_id.rsplit("/", 1)[-1])
        assert same_rows(read_export(spark, row.target, fmt, table.schema), table), row.task_id


def test_failed_task_does_not_stop_the_others(spark, lake, out):
    options = ExportOptions(target=out + "/{table}")
    good = schema_tasks(lake, "dbo", options, include=["*.nation", "*.region"])
    bad = one_table_tasks(lake, "dbo", "orders", options, "nothing = 1")
    results = run_job(lake, good.unionByName(bad), options)
    totals = summary(results).first()
    assert (totals.completed_tasks, totals.failed_tasks, totals.rows_exported) == (2, 1, 30)
    assert totals.files_written == 2 and totals.bytes_written > 0
    assert len(totals.errors) == 1 and totals.errors[0].startswith("table:dbo/orders: ")
    with pytest.raises(RuntimeError, match="table:dbo/orders: "):
        raise_on_failure(results)


def test_query_export_with_template_slices(spark, lake, out):
    options = ExportOptions(target=out + "/{query}")
    sql = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'"
    tasks = query_tasks(lake, "open orders", sql, options, "o_orderkey BETWEEN {lo} AND {hi}")

    def slicer(task, frame):
        return template_slices(frame, "o_orderkey", task.partition_hint, 3)

    results = raise_on_failure(run_job(lake, tasks, options, slicer)).collect()
    assert len(results) == 3 and all(r.rows for r in results)
    frame = lake.query(sql)
    assert same_rows(read_export(spark, out + "/open orders", "parquet", frame.schema), frame)


@pytest.mark.parametrize("per_pass", [1, 2, 32])
def test_sliced_export_is_complete_whatever_the_passes(spark, lake, out, per_pass):
    options = ExportOptions(
        target=out + "/{table}", slices_per_pass=per_pass, max_rows_per_file=100
    )
    slices = range_slices("o_orderkey", T.LongType(), 0, 2000, 5, "dbo/orders", nulls=True)
    tasks = one_table_tasks(lake, "dbo", "orders", options)
    results = raise_on_failure(run_job(lake, tasks, options, lambda t, f: slices)).collect()
    orders = lake.frame("dbo", "orders")
    assert sum(r.rows for r in results) == orders.count()
    assert same_rows(read_export(spark, out + "/orders", "parquet", orders.schema), orders)


def test_resume_does_what_is_left(spark, lake, out):
    options = ExportOptions(
        target=out + "/{table}", manifest_dir=out + "-manifest", resume=True, slices_per_pass=1
    )
    tasks = one_table_tasks(lake, "dbo", "orders", options)
    good = ["o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'P'"]
    broken = [good[0], "nothing = 1", good[2]]

    def run(predicates):
        results = run_job(lake, tasks, options, lambda t, f: predicate_slices(predicates), "job")
        return {r.slice_id: r.status for r in results.collect()}

    assert run(broken) == {
        "p00000000": "completed", "p00000001": "failed", "p00000002": "completed"
    }
    assert run(good) == {"p00000000": "skipped", "p00000001": "completed", "p00000002": "skipped"}
    assert set(run(good).values()) == {"skipped"}
    records = Manifest(spark, options.manifest_dir).records()
    assert illegal_moves(records).count() == 0
    last = {r.partition_id: (r.status, r.attempt) for r in latest(records).collect()}
    assert last == {
        "p00000000": ("committed", 1), "p00000001": ("committed", 2), "p00000002": ("committed", 1)
    }
    orders = lake.frame("dbo", "orders")
    assert same_rows(read_export(spark, out + "/orders", "parquet", orders.schema), orders)


def test_jdbc_options_are_built_without_a_connection(spark):
    source = JdbcSource(spark, "db.example.com", "shop", user="u", password="p")
    assert source.options["url"] == (
        "jdbc:sqlserver://db.example.com:1433;databaseName=shop;"
        "encrypt=true;trustServerCertificate=true"
    )
    assert source._single()["sessionInitStatement"] == "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"
    with pytest.raises(ValueError, match="one slice"):
        source.sliced("dbo", "orders", [Slice("a", "id < 1"), Slice("b", "id >= 1")])
    plain = JdbcSource(spark, "h", "shop", consistency="none", port=1500, trust_certificate=False)
    assert "sessionInitStatement" not in plain._single()
    assert ":1500;" in plain.options["url"] and "user" not in plain.options


def test_jdbc_settings_that_cannot_work_are_refused(spark):
    with pytest.raises(ValueError):
        JdbcSource(spark, " ", "shop")
    with pytest.raises(ValueError):
        JdbcSource(spark, "h", "shop", consistency="database_snapshot")
    frozen = JdbcSource(
        spark, "h", "shop", consistency="database_snapshot", snapshot_database="shop_frozen"
    )
    assert "databaseName=shop_frozen;" in frozen.options["url"]
