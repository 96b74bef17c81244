import pytest
from pyspark.sql import functions as F

from tablelift.options import ExportOptions
from tablelift.plans.tasks import (
    database_tasks,
    dry_run,
    one_table_tasks,
    query_tasks,
    schema_tasks,
)
from tablelift.sources.catalog import TABLES_SCHEMA, SparkSource, base_tables

OPTIONS = ExportOptions(target="s3://lake/raw/{schema}/{table}/")


class FixedSource:
    def __init__(self, spark, *tables, database=None):
        self.spark = spark
        self.rows = [(database, s, t, "BASE TABLE") for s, t in tables]

    def tables(self):
        view = (None, "dbo", "a_view", "VIEW")
        return self.spark.createDataFrame([*self.rows, view], TABLES_SCHEMA)


def test_schema_scope_expands_to_tasks_with_own_targets(spark):
    source = FixedSource(spark, ("dbo", "b"), ("dbo", "a"), ("sales", "c"), ("DBO", "d"))
    tasks = schema_tasks(source, "Dbo", OPTIONS, exclude=["*.b"]).collect()
    assert {t.task_id: t.target_prefix for t in tasks} == {
        "table:dbo/a": "s3://lake/raw/dbo/a/",
        "table:DBO/d": "s3://lake/raw/DBO/d/",
    }
    assert tasks[0].sql.startswith("select * from `")


def test_tables_come_in_name_order_without_views(spark):
    source = FixedSource(spark, ("sales", "c"), ("dbo", "b"), ("dbo", "a"))
    names = [(r.table_schema, r.table_name) for r in base_tables(source.tables()).collect()]
    assert names == [("dbo", "a"), ("dbo", "b"), ("sales", "c")]


def test_database_scope_and_three_part_names(spark):
    source = FixedSource(spark, ("dbo", "a"), ("sales", "c"), database="shop")
    tasks = database_tasks(source, OPTIONS, include=["shop.sales.*"]).collect()
    assert [t.task_id for t in tasks] == ["table:shop/sales/c"]
    assert tasks[0].sql == "select * from `shop`.`sales`.`c`"


def test_empty_scope_is_an_error(spark):
    source = FixedSource(spark, ("dbo", "a"))
    with pytest.raises(LookupError, match="no exportable tables found for audit"):
        schema_tasks(source, "audit", OPTIONS)
    with pytest.raises(LookupError, match="no exportable tables found for database"):
        database_tasks(source, OPTIONS, exclude=["*"])


def test_shared_targets_are_refused(spark):
    source = FixedSource(spark, ("dbo", "a"), ("dbo", "b"))
    with pytest.raises(ValueError, match="share the target"):
        schema_tasks(source, "dbo", ExportOptions(target="/lake/{schema}/"))


def test_table_task_carries_its_predicate(spark):
    source = FixedSource(spark, ("dbo", "o`d"))
    task = one_table_tasks(source, "dbo", "o`d", OPTIONS, "id > 5").first()
    assert task.sql == "select * from `dbo`.`o``d` where id > 5"
    assert task.predicate == "id > 5"


def test_query_task_keeps_its_text(spark):
    source = FixedSource(spark)
    sql = "SELECT  *\nFROM orders -- all"
    options = ExportOptions(target="/out/{query}/{file_index}.json")
    task = query_tasks(source, "daily/orders", sql, options, "id BETWEEN {lo} AND {hi}").first()
    assert task.task_id == "query:daily_orders"
    assert task.sql == sql
    assert task.target_prefix == "/out/daily_orders/{file_index}.json"
    assert task.partition_hint == "id BETWEEN {lo} AND {hi}"


@pytest.mark.parametrize("name, sql", [("", "select 1"), ("q", "  ")])
def test_query_needs_name_and_text(spark, name, sql):
    with pytest.raises(ValueError):
        query_tasks(FixedSource(spark), name, sql, OPTIONS)


def test_schema_needs_a_name(spark):
    with pytest.raises(ValueError):
        schema_tasks(FixedSource(spark, ("dbo", "a")), " ", OPTIONS)


def test_dry_run_counts_tasks(spark):
    source = FixedSource(spark, ("dbo", "a"), ("dbo", "b"))
    assert tuple(dry_run(schema_tasks(source, "dbo", OPTIONS)).first()) == (2, 0, 0, 0)


def test_lake_catalog(lake):
    assert base_tables(lake.tables(), "DBO").count() == 14
    columns = lake.columns("dbo", "nation").collect()
    assert [c.column_name for c in columns] == ["n_nationkey", "n_name", "n_regionkey"]
    with pytest.raises(LookupError):
        lake.frame("dbo", "nothing")


def test_spark_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    spark.sql("CREATE TABLE sales.items (id INT, price DECIMAL(9,2)) USING parquet")
    spark.sql("INSERT INTO sales.items VALUES (1, 2.50)")
    source = SparkSource(spark)
    found = base_tables(source.tables(), "SALES").collect()
    assert [(r.table_schema, r.table_name) for r in found] == [("sales", "items")]
    price = source.columns("sales", "items").where(F.col("column_name") == "price").first()
    assert (price.data_type, price.numeric_precision, price.numeric_scale) == ("decimal", 9, 2)
    assert source.frame("sales", "items").count() == 1
