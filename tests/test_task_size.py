"""No task takes more of a shuffle than a bound, however many rows fill a file."""

import pytest
from pyspark.sql import functions as F

from tablelift import ExportOptions
from tablelift.operators import layout
from tablelift.operators.sinks import export_frame, export_slices
from tablelift.operators.slices import predicate_slices
from tablelift.sources.readback import read_export

ROWS = 4_000


@pytest.fixture
def table(spark, tmp_path):
    wide = spark.range(ROWS).select("id", F.repeat(F.lit("x"), 100).alias("text")).repartition(16)
    wide.write.parquet(str(tmp_path / "table"))
    return spark.read.parquet(str(tmp_path / "table"))


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(layout, "TASK_BYTES", 64 * 1024, raising=False)


def rows_of_files(spark, folder, schema):
    back = read_export(spark, folder, "parquet", schema)
    return [r["count"] for r in back.groupBy(F.col("_metadata.file_name").alias("file")).count().collect()]


@pytest.mark.parametrize("arrow", [False, True])
@pytest.mark.parametrize("known", [False, True])
def test_a_slice_is_dealt_to_tasks_of_bounded_size(spark, table, out, small_tasks, known, arrow):
    slices = predicate_slices(["id < 3900", "id >= 3900"])
    frame = table.withColumn("more", F.col("id") + 1)
    done = export_slices(frame, slices, out, ExportOptions(target=out, arrow_files=arrow), table if known else None)
    assert [p.rows for p in done] == [3_900, 100]
    # A row is about 130 bytes.
    held = rows_of_files(spark, done[0].target, frame.schema)
    assert sum(held) == 3_900 and max(held) <= 64 * 1024 / 100
    back = read_export(spark, done[0].target, "parquet", frame.schema)
    assert back.select("id").distinct().count() == 3_900 and back.where("more <> id + 1").isEmpty()


def test_few_rows_of_a_table_are_dealt_to_tasks_of_bounded_size(spark, table, monkeypatch, small_tasks):
    options = ExportOptions(target="/x").checked()
    kept = spark.createDataFrame(table.where("id < 2000").rdd, table.schema).repartition(200)
    # One file would take all rows; before, so did one task.
    filled = layout.fill_files(kept, table, ROWS, options)
    sizes = [r.n for r in filled.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2_000 and len(sizes) >= 4 and max(sizes) <= 64 * 1024 / 100
    even = layout.fill_files(table, table, ROWS, ExportOptions(target="/x", even_files=True).checked())
    assert even.rdd.getNumPartitions() >= 7


def test_a_task_for_more_rows_than_fit_is_not_made_at_the_usual_size(spark, table, out):
    slices = predicate_slices(["id < 3900", "id >= 3900"])
    done = export_slices(table, slices, out, ExportOptions(target=out), table)
    assert [(p.rows, p.files) for p in done] == [(3_900, 1), (100, 1)]
    assert export_frame(table.where("id % 2 = 0"), out + "-half", ExportOptions(target=out), table).rows == 2_000


def test_width_of_rows_behind_a_shuffle_comes_from_their_types(spark):
    counts = spark.range(100).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
    assert layout.rows_per_task(counts, None) == layout.TASK_BYTES // 32
    empty = spark.range(0)
    assert layout.rows_per_task(empty, None) > 1
