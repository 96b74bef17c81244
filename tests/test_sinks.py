import datetime as dt
import gzip
import json
import os
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import same_rows
from pyspark.sql import Row, functions as F

from tablelift import storage
from tablelift.operators.layout import SIZE_TOLERANCE
from tablelift.operators.sinks import export_frame, export_slices, publish
from tablelift.operators.slices import predicate_slices
from tablelift.options import ExportOptions
from tablelift.sources.readback import read_export
from tablelift.storage import Store, file_stats, hadoop_uri

FORMATS = [
    ("parquet", "none"), ("parquet", "snappy"), ("parquet", "zstd"), ("csv", "none"),
    ("csv", "gzip"), ("csv", "zstd"), ("tsv", "none"), ("tsv", "gzip"), ("tsv", "zstd"),
    ("json", "none"), ("json", "gzip"), ("json", "zstd"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Every type, and text that a careless writer breaks."""
    schema = (
        "id long, flag boolean, small smallint, amount decimal(18,4), ratio double, "
        "day date, moment timestamp_ntz, instant timestamp, raw binary, "
        "items array<int>, pair struct<a:int,b:string>, words map<string,int>, note string"
    )
    moment = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    texts = [
        None, "", " ", "  padded  ", "a,b", "a\tb", 'say "hi"', '"', "line\nbreak", "cr\r\nlf",
        "back\\slash", "\\N", "null", "{}", "žluťoučký 数据 🙂", "'", "#comment", ",", "a\\\"b",
    ]
    rows = [
        (
            i, i % 2 == 0, i, Decimal("12345.6789"), 0.1 * i, moment.date(), moment, moment,
            bytes([0, 255, i]), [i, None, 2], Row(a=i, b=text), {"k": i}, text,
        )
        for i, text in enumerate(texts)
    ]
    rows.append((None,) * 13)
    return spark.createDataFrame(rows, schema)


def comparable(df):
    return sorted(
        [tuple(r.asDict(recursive=True).items()).__repr__() for r in df.collect()]
    )


@pytest.mark.parametrize("fmt, codec", FORMATS)
def test_round_trip_of_awkward_values(spark, awkward, out, fmt, codec):
    options = ExportOptions(target=out, format=fmt, compression=codec)
    done = export_frame(awkward, out, options)
    assert done.rows == awkward.count()
    assert comparable(read_export(spark, out, fmt, awkward.schema)) == comparable(awkward)
    names = sorted(n for n in os.listdir(out) if not n.startswith("."))
    assert names == [options.checked().file_name(i) for i in range(len(names))]
    assert done.files == len(names)


@pytest.mark.parametrize("fmt, codec", [f for f in FORMATS if f[0] in ("csv", "tsv")])
def test_lone_null_column_keeps_its_rows(spark, out, fmt, codec):
    df = spark.createDataFrame([(None,), ("",), ("a",), (None,)], "only string")
    export_frame(df, out, ExportOptions(target=out, format=fmt, compression=codec))
    assert comparable(read_export(spark, out, fmt, df.schema)) == comparable(df)


def test_csv_has_one_header_per_file(spark, out):
    options = ExportOptions(target=out, format="csv", compression="gzip", max_rows_per_file=10)
    export_frame(spark.range(0, 35, numPartitions=1), out, options)
    files = sorted(n for n in os.listdir(out) if n.startswith("part"))
    assert len(files) == 4
    for name in files:
        lines = gzip.open(f"{out}/{name}", "rt").read().splitlines()
        assert lines[0] == "id" and "id" not in lines[1:]


def test_json_leaves_nulls_out(spark, out):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    export_frame(df, out, ExportOptions(target=out, format="json", compression="none"))
    assert json.loads(open(f"{out}/part-00000.jsonl").read()) == {"a": 1}


def test_parquet_codec_and_row_groups(spark, out):
    options = ExportOptions(target=out, compression="zstd", row_group_bytes=64 * 1024)
    made = spark.range(0, 200_000, numPartitions=1).withColumn("x", F.xxhash64("id"))
    export_frame(made, out, options)
    meta = pq.ParquetFile(f"{out}/part-00000.parquet").metadata
    assert meta.num_row_groups > 1
    assert meta.row_group(0).column(0).compression == "ZSTD"


@pytest.mark.parametrize("codec", ["gzip", "zstd"])
def test_row_limit_is_exact(spark, out, codec):
    options = ExportOptions(target=out, format="json", compression=codec, max_rows_per_file=400)
    done = export_frame(spark.range(0, 1500, numPartitions=1), out, options)
    rows = read_export(spark, out, "json", spark.range(1).schema)
    counts = [r[1] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert sorted(counts) == [300, 400, 400, 400]
    assert done.files == 4


@pytest.mark.parametrize("fmt, codec", [("parquet", "snappy"), ("csv", "none"), ("json", "gzip"), ("csv", "zstd")])
def test_size_limit_holds_for_a_misleading_sample(spark, out, fmt, codec):
    """Narrow rows first, wide ones after: the sample is wrong, the files are not."""
    wide = F.concat_ws("-", *[F.sha2(F.concat("id", F.lit(i)).cast("string"), 256) for i in range(40)])
    df = spark.range(0, 20_000, numPartitions=2).withColumn(
        "text", F.when(F.col("id") < 10_000, F.lit("x")).otherwise(wide)
    )
    source = out + "-source"
    df.write.parquet(source)
    table = spark.read.parquet(source)
    goal = 3_000_000
    options = ExportOptions(target=out, format=fmt, compression=codec, target_file_bytes=goal)
    done = export_frame(table, out, options, table)
    sizes = [r.bytes for r in file_stats(spark, out).collect()]
    assert max(sizes) <= SIZE_TOLERANCE * goal
    assert (done.rows, done.bytes, done.files) == (20_000, sum(sizes), len(sizes))
    assert same_rows(read_export(spark, out, fmt, df.schema), df)


def test_query_result_is_split_without_a_sample(spark, out):
    df = spark.range(0, 50_000, numPartitions=1).withColumn("x", F.sha2(F.col("id").cast("string"), 256))
    goal = 500_000
    export_frame(df, out, ExportOptions(target=out, target_file_bytes=goal))
    sizes = [r.bytes for r in file_stats(spark, out).collect()]
    assert len(sizes) > 4 and max(sizes) <= SIZE_TOLERANCE * goal
    assert same_rows(read_export(spark, out, "parquet", df.schema), df)


@pytest.mark.parametrize("fmt, codec", [("parquet", "snappy"), ("csv", "gzip"), ("json", "none")])
def test_very_many_small_files_are_merged(spark, awkward, out, fmt, codec):
    notes = F.get(F.array(*[F.lit(r.note) for r in awkward.collect()]), (F.col("id") % 20).cast("int"))
    wide = spark.range(0, 5_000, numPartitions=70).withColumn("note", notes)
    options = ExportOptions(target=out, format=fmt, compression=codec)
    done = export_frame(wide, out, options)
    assert (done.rows, done.files) == (5_000, 1)
    assert same_rows(read_export(spark, out, fmt, wide.schema), wide)


def test_rows_of_a_selective_filter_are_brought_together(spark, out):
    source = out + "-source"
    made = spark.range(0, 40_000, numPartitions=40).withColumn(
        "x", F.sha2(F.col("id").cast("string"), 256)
    )
    made.write.parquet(source)
    with_small_splits = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in with_small_splits}
    for k, v in with_small_splits.items():
        spark.conf.set(k, v)
    try:
        table = spark.read.parquet(source)
        goal = ExportOptions(target=out, target_file_bytes=1_000_000)
        done = export_frame(table.where("id % 100 = 0"), out, goal, table)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert (done.rows, done.files) == (400, 1)


def test_overwrite_replaces_and_append_adds(spark, out):
    many = ExportOptions(target=out, max_rows_per_file=10)
    export_frame(spark.range(100), out, many)
    export_frame(spark.range(5), out, ExportOptions(target=out))
    assert read_export(spark, out, "parquet", spark.range(1).schema).count() == 5
    before = set(os.listdir(out))
    export_frame(spark.range(7), out, ExportOptions(target=out, mode="append"))
    assert before < set(os.listdir(out))
    assert read_export(spark, out, "parquet", spark.range(1).schema).count() == 12
    with pytest.raises(FileExistsError):
        export_frame(spark.range(1), out, ExportOptions(target=out, mode="errorifexists"))


@pytest.mark.parametrize("fmt, codec", [("parquet", "snappy"), ("csv", "none"), ("json", "zstd")])
def test_empty_result_leaves_no_files(spark, out, fmt, codec):
    options = ExportOptions(target=out, format=fmt, compression=codec)
    done = export_frame(spark.range(0), out, options)
    assert (done.rows, done.bytes, done.files) == (0, 0, 0)
    assert file_stats(spark, out).count() == 0
    assert read_export(spark, out, fmt, spark.range(1).schema).count() == 0


def test_empty_first_task_leaves_no_empty_file(spark, out):
    df = spark.range(0, 1000, numPartitions=4).where("id >= 500")
    done = export_frame(df, out, ExportOptions(target=out))
    assert (done.rows, done.files) == (500, 2)


def test_failed_export_leaves_the_old_files(spark, out):
    export_frame(spark.range(3), out, ExportOptions(target=out))
    bad = spark.range(10).select(F.assert_true(F.col("id") < 5).cast("string").alias("x"))
    with pytest.raises(Exception):
        export_frame(bad, out, ExportOptions(target=out))
    assert read_export(spark, out, "parquet", spark.range(1).schema).count() == 3
    assert os.listdir(os.path.dirname(out)) == ["out"]


def test_failed_swap_puts_the_old_folder_back(spark, out):
    export_frame(spark.range(3), out, ExportOptions(target=out))
    with pytest.raises(Exception):
        publish(Store(spark, out), out + "-missing", "single", out, 1, ExportOptions(target=out))
    assert read_export(spark, out, "parquet", spark.range(1).schema).count() == 3


@pytest.mark.parametrize("options", [{}, {"max_rows_per_file": 100}, {"format": "csv", "compression": "zstd"}])
def test_slices_go_to_their_own_folders(spark, out, options):
    df = spark.range(0, 1000, numPartitions=3)
    slices = predicate_slices(["id < 700", "id >= 600", "id < 0"])
    done = export_slices(df, slices, out, ExportOptions(target=out, **options))
    assert [(d.slice_id, d.rows) for d in done] == [
        ("p00000000", 700), ("p00000001", 400), ("p00000002", 0)
    ]
    fmt = options.get("format", "parquet")
    counts = [read_export(spark, d.target, fmt, df.schema).count() for d in done]
    assert counts == [700, 400, 0]
    if "max_rows_per_file" in options:
        assert done[0].files >= 7


def test_a_slice_with_most_rows_is_spread(spark, out):
    """Equal rows in one slice still make as many files as their number asks for."""
    df = spark.range(0, 9_000, numPartitions=3).select(
        F.when(F.col("id") < 8_000, F.lit(1)).otherwise(F.lit(2)).alias("k")
    )
    slices = predicate_slices(["k = 1", "k = 2"])
    done = export_slices(df, slices, out, ExportOptions(target=out, max_rows_per_file=1_000))
    back = read_export(spark, done[0].target, "parquet", df.schema)
    largest = max(r[1] for r in back.groupBy(F.input_file_name()).count().collect())
    assert done[0].files >= 8 and largest <= 1_000


def test_slices_of_shuffled_rows_are_whole(spark, out):
    df = spark.range(0, 6_000).select((F.col("id") % 40).alias("k"), F.lit("same").alias("t"))
    shuffled = df.repartition(5, "k")
    slices = predicate_slices(["k < 35", "k >= 35"])
    export_slices(shuffled, slices, out, ExportOptions(target=out, max_rows_per_file=500))
    assert same_rows(read_export(spark, out, "parquet", df.schema), df)


def test_spark_file_names_can_be_kept(spark, out):
    export_frame(spark.range(3), out, ExportOptions(target=out, numbered_files=False))
    assert all("-c000" in n for n in os.listdir(out) if n.startswith("part"))


@pytest.mark.parametrize(
    "target, uri",
    [
        ("/data/export/", "/data/export/"),
        ("./output/", "./output/"),
        ("file:///tmp/data", "file:///tmp/data"),
        ("s3://my-bucket/prefix/path", "s3a://my-bucket/prefix/path"),
        ("gs://bucket/p", "gs://bucket/p"),
        ("az://box/p", "abfss://box@acc.dfs.core.windows.net/p"),
        ("abfs://box@other.dfs.core.windows.net/p", "abfss://box@other.dfs.core.windows.net/p"),
    ],
)
def test_storage_targets(target, uri):
    assert hadoop_uri(target, azure_account="acc") == uri


@pytest.mark.parametrize("target", ["s3://", "gs:///x", "az://"])
def test_targets_without_a_bucket_are_refused(target):
    with pytest.raises(ValueError, match="bucket"):
        hadoop_uri(target)


def test_plans_that_are_empty_before_they_run(spark, out):
    empty = spark.range(10).where("false")
    assert export_frame(empty, out, ExportOptions(target=out)).files == 0
    slices = predicate_slices(["id < 5", "id >= 5"])
    done = export_slices(empty, slices, out, ExportOptions(target=out))
    assert [d.rows for d in done] == [0, 0]


@pytest.mark.parametrize("fmt, codec", [("parquet", "snappy"), ("csv", "gzip"), ("json", "zstd")])
def test_stores_that_cannot_rename_are_written_in_place(spark, out, monkeypatch, fmt, codec):
    monkeypatch.setattr(storage, "RENAMING_SCHEMES", set())
    options = ExportOptions(target=out, format=fmt, compression=codec, max_rows_per_file=40)
    df = spark.range(0, 100, numPartitions=1)
    for _ in range(2):
        done = export_frame(df, out, options)
        assert (done.rows, done.files) == (100, 3)
    assert same_rows(read_export(spark, out, fmt, df.schema), df)
    slices = predicate_slices(["id < 30", "id >= 30", "id < 0"])
    parts = export_slices(df, slices, out + "-sliced", options)
    assert [p.rows for p in parts] == [30, 70, 0]
    assert same_rows(read_export(spark, out + "-sliced", fmt, df.schema), df)
    assert export_frame(df.where("id < 0"), out, options).files == 0
    assert file_stats(spark, out).count() == 0
